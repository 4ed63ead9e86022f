"""Exact quantiles of huge groups without holding a group in one task.

Spark's exact ``percentile``/``median`` merges every distinct value of a
group into one aggregation buffer, so a global median over a table with
billions of rows lands in one task.  Here the value at a given rank is found
by histogram refinement:

1. ``percentile_approx`` (a bounded sketch) proposes bucket bounds inside
   the current bracket of every open target;
2. an exact count per bucket (a small result: targets x buckets rows) tells
   which bucket holds the rank;
3. the bracket shrinks to that bucket, and once a bracket holds at most
   ``max_exact`` values they are sorted within a bounded group.

Quantiles interpolate linearly between neighbouring ranks (numpy/pandas
default, Spark ``percentile``).  Use it for few, large groups (columns of a
table); for many small groups use ``F.percentile`` directly.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucket_index(bounds, v, n_bounds: int):
    """Number of sorted ``bounds`` strictly below ``v`` (binary search in
    ``ceil(log2(n+1))`` steps instead of ``n`` comparisons)."""
    steps = max(1, math.ceil(math.log2(n_bounds + 1)))
    init = F.struct(F.lit(0).alias("l"), F.size(bounds).alias("h"))

    def step(acc, _):
        mid = F.floor((acc["l"] + acc["h"]) / 2).cast("int")
        below = F.when(acc["l"] < acc["h"], F.get(bounds, mid) < v).otherwise(F.lit(False))
        return F.struct(F.when(below, mid + 1).otherwise(acc["l"]).alias("l"),
                        F.when((acc["l"] < acc["h"]) & ~below, mid).otherwise(acc["h"]).alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["l"]


def _search_tree(bounds, v, lo: int, hi: int):
    """Literal binary search: number of ``bounds[lo:hi]`` below ``v`` plus ``lo``.
    Compiles to nested comparisons (whole-stage codegen, log2 depth)."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(v > F.lit(float(bounds[mid])), _search_tree(bounds, v, mid + 1, hi)).otherwise(
        _search_tree(bounds, v, lo, mid))


def _bucket_expr(bounds_by_bracket: dict, b, v):
    expr = None
    for key, bounds in bounds_by_bracket.items():
        t = _search_tree(bounds, v, 0, len(bounds))
        expr = F.when(b == F.lit(key), t) if expr is None else expr.when(b == F.lit(key), t)
    return expr.otherwise(F.lit(0))


def select_ranks(values: DataFrame, group_col: str, value_col: str, wanted: dict,
                 max_exact: int = 50_000, n_buckets: int = 64,
                 group_counts: dict | None = None, initial_bounds: dict | None = None) -> dict:
    """Exact value at 0-based rank ``r`` of each group, for ``wanted = {group: [r, ...]}``.

    Work is organised by *bracket* ``(group, lo, hi]``: all ranks that fall
    into the same bracket share one pass, and brackets of one group never
    overlap, so every value is read once per round.  Only bracket counts,
    bucket bounds and the picked values reach the driver.
    """
    spark = values.sparkSession
    v = values.select(F.col(group_col).cast("string").alias("_g"), F.col(value_col).cast("double").alias("_v"))
    # bracket id -> (group, lo, hi, count, [(target key, rank inside bracket)], heavy value or False)
    brackets = {}
    bid = 0
    for g, ranks in wanted.items():
        cnt = (group_counts or {}).get(g)
        brackets[bid] = (str(g), None, None, cnt, [((g, r), int(r)) for r in sorted(set(ranks))], False)
        bid += 1
    result: dict = {}

    def members(of: dict) -> DataFrame:
        """Values with their bracket, as one compiled CASE (brackets are few and disjoint per group)."""
        member = None
        for b, x in of.items():
            cond = F.col("_g") == F.lit(x[0])
            if x[1] is not None:
                cond = cond & (F.col("_v") > F.lit(float(x[1])))
            if x[2] is not None:
                cond = cond & (F.col("_v") <= F.lit(float(x[2])))
            member = F.when(cond, F.lit(b)) if member is None else member.when(cond, F.lit(b))
        return v.select(member.alias("_b"), "_v").where(F.col("_b").isNotNull())

    # every round finishes a bracket or makes it smaller: a bracket that its
    # buckets cannot split holds a heavy value, and the split around that
    # value takes at least its copies away
    while brackets:
        inb = members(brackets)
        if any(x[3] is None for x in brackets.values()):
            got = {r["_b"]: r["n"] for r in inb.groupBy("_b").agg(F.count("*").alias("n")).collect()}
            brackets = {b: (x[0], x[1], x[2], got.get(b, 0), x[4], x[5]) for b, x in brackets.items()}
        stuck = {b: x for b, x in brackets.items() if x[5] is not False and x[3] > max_exact}
        if stuck:
            # split three ways around the heavy value: below, equal, above --
            # one aggregate, two numbers per bracket
            hv = None
            for b, x in stuck.items():
                at = F.lit(float(x[5]))
                hv = F.when(F.col("_b") == F.lit(b), at) if hv is None else hv.when(F.col("_b") == F.lit(b), at)
            split = {r["_b"]: (r["lt"], r["eq"]) for r in
                     inb.where(F.col("_b").isin(list(stuck))).withColumn("_h", hv)
                     .groupBy("_b").agg(F.count_if(F.col("_v") < F.col("_h")).alias("lt"),
                                        F.count_if(F.col("_v") == F.col("_h")).alias("eq")).collect()}
            brackets = {b: x for b, x in brackets.items() if b not in stuck}
            for b, (g, lo, hi, cnt, targets, v_star) in stuck.items():
                lt, eq = split[b]
                below = [(key, r) for key, r in targets if r < lt]
                above = [(key, r - lt - eq) for key, r in targets if r >= lt + eq]
                result.update({key: float(v_star) for key, r in targets if lt <= r < lt + eq})
                # all targets on one side share one bracket
                if below:
                    brackets[bid] = (g, lo, math.nextafter(float(v_star), -math.inf), lt, below, False)
                if above:
                    brackets[bid + 1] = (g, float(v_star), hi, cnt - lt - eq, above, False)
                bid += 2
            if not brackets:
                break
            inb = members(brackets)
        small = {b: x for b, x in brackets.items() if x[3] <= max_exact}
        big = {b: x for b, x in brackets.items() if x[3] > max_exact}
        if small:
            picks = spark.createDataFrame([(b, i, r) for b, x in small.items() for i, (_, r) in enumerate(x[4])],
                                          "_b long, _i int, _r long")
            sorted_vals = (inb.where(F.col("_b").isin(list(small)))
                           .groupBy("_b").agg(F.sort_array(F.collect_list("_v")).alias("_s")))
            rows = (sorted_vals.join(F.broadcast(picks), "_b")
                    .select("_b", "_i", F.element_at("_s", (F.col("_r") + 1).cast("int")).alias("_x"))
                    .collect())
            for row in rows:
                result[small[row["_b"]][4][row["_i"]][0]] = row["_x"]
        brackets = big
        if not big:
            break
        probs = [i / n_buckets for i in range(1, n_buckets)]
        sub = inb.where(F.col("_b").isin(list(big)))
        if initial_bounds and all(x[1] is None and x[2] is None and x[0] in initial_bounds for x in big.values()):
            # whole groups: their bounds came with the counts (no extra pass)
            bounds = {b: initial_bounds[x[0]] for b, x in big.items()}
        else:
            bounds = {r["_b"]: sorted(set(r["_q"])) for r in
                      sub.groupBy("_b").agg(F.percentile_approx("_v", probs, 10_000).alias("_q")).collect()}
        hist = (sub.withColumn("_k", _bucket_expr(bounds, F.col("_b"), F.col("_v")))
                .groupBy("_b", "_k")
                .agg(F.count("*").alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx"))
                .collect())
        per: dict = {}
        for row in hist:
            per.setdefault(row["_b"], []).append((row["_k"], row["n"], row["mn"], row["mx"]))
        new_brackets = {}
        for b, (g, lo, hi, cnt, targets, _) in big.items():
            qb = bounds[b]
            cells = sorted(per.get(b, []))
            for key, r in targets:
                below = 0
                for k, n, mn, mx in cells:
                    if r < below + n:
                        if mn == mx:
                            result[key] = mn
                        else:
                            nlo = qb[k - 1] if k > 0 else lo
                            nhi = qb[k] if k < len(qb) else hi
                            # merge targets that land in the same new bracket
                            found = None
                            for nb, x in new_brackets.items():
                                if x[0] == g and x[1] == nlo and x[2] == nhi:
                                    found = nb
                            if found is None:
                                found = bid
                                bid += 1
                                # no progress: remember the likely heavy value for a 3-way split
                                heavy_v = (qb[len(qb) // 2] if qb else mx) if n == cnt else False
                                new_brackets[found] = (g, nlo, nhi, n, [], heavy_v)
                            new_brackets[found][4].append((key, r - below))
                        break
                    below += n
        brackets = new_brackets
    return result


def exact_quantiles(df: DataFrame, columns, probs, persist: bool = False, **kw) -> dict:
    """``{column: [q(p) for p in probs]}`` exact, linear interpolation, nulls/NaN skipped.

    All columns are handled in the same passes (unpivoted to one long table).
    """
    columns = list(columns)
    long = (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
            .unpivot([], columns, "_g", "_v")
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    if not persist:
        return _exact_quantiles(long, columns, probs, **kw)
    # an expensive input is read by several small jobs: keep it (memory,
    # then disk; a lost block is recomputed from lineage)
    long = long.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _exact_quantiles(long, columns, probs, **kw)
    finally:
        long.unpersist()


def _exact_quantiles(long: DataFrame, columns, probs, **kw) -> dict:
    ns = {c: 0 for c in columns}
    n_buckets = kw.get("n_buckets", 64)
    probs_b = [i / n_buckets for i in range(1, n_buckets)]
    first_bounds = {}
    # counts and first bucket bounds of every column in one pass
    for r in (long.groupBy("_g").agg(F.count("*").alias("n"),
                                    F.percentile_approx("_v", probs_b, 10_000).alias("_q")).collect()):
        ns[r["_g"]] = r["n"]
        first_bounds[r["_g"]] = sorted(set(r["_q"] or []))
    wanted, plan = {}, {}
    for c in columns:
        n = ns[c]
        if n == 0:
            continue
        for p in probs:
            h = (n - 1) * float(p)
            r0 = int(math.floor(h))
            r1 = min(r0 + 1, n - 1)
            plan[(c, p)] = (r0, r1, h - r0)
            wanted.setdefault(c, set()).update({r0, r1})
    got = (select_ranks(long, "_g", "_v", wanted, group_counts=ns, initial_bounds=first_bounds, **kw)
           if wanted else {})
    out = {}
    for c in columns:
        vals = []
        for p in probs:
            if (c, p) not in plan:
                vals.append(None)
                continue
            r0, r1, frac = plan[(c, p)]
            a, b = got[(c, r0)], got[(c, r1)]
            vals.append(a + (b - a) * frac if frac else a)
        out[c] = vals
    return out


def exact_medians(df: DataFrame, columns, **kw) -> dict:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5], **kw).items()}
