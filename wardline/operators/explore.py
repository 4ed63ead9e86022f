"""Exploration aggregates.

Everything here is one or two aggregation passes; what reaches the driver is
bounded by the number of columns (or columns x bins), never by row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.common import broadcast_if_bounded
from wardline.operators.quantiles import exact_quantiles


def _q(c):
    return F.col(f"`{c}`")


def _long(df: DataFrame, columns, by=()) -> DataFrame:
    by = list(by)
    return (df.select(*[_q(b) for b in by], *[_q(c).cast("double").alias(c) for c in columns])
            .unpivot(by, list(columns), "column", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def histogram(df: DataFrame, columns, bins: int = 10, by=()) -> DataFrame:
    """Equal-width histogram per column (and per ``by`` group).

    Edges run from the group's min to its max (a constant group gets
    ``v - 0.5 .. v + 0.5``); the last bin is closed.  Empty bins are listed
    with count 0.  Output ``(by..., column, bin, lower, upper, count)``.
    Two aggregations: range per group, then counts per (group, bin); the
    bin skeleton is generated per group with ``sequence``, not a cross join.
    The ranges go to the values, so that no values are shuffled: by a broadcast
    up to its limit of groups; beyond, groups are joined by key.
    """
    by = list(by)
    keys = by + ["column"]
    long = _long(df, columns, by)
    rng = (long.groupBy(*keys).agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
           .select(*keys,
                   F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                   F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi")))
    rng = broadcast_if_bounded(rng)  # one row per (group, column)
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    idx = F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))),
                  F.lit(bins - 1)).cast("int")
    counts = (long.join(rng, keys).select(*keys, idx.alias("bin"))
              .groupBy(*keys, "bin").agg(F.count("*").alias("count")))
    skeleton = rng.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (skeleton.join(counts, keys + ["bin"], "left")
            .select(*keys, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def correlation_matrix(df: DataFrame, columns, by=()) -> DataFrame:
    """Pearson correlation of every ordered column pair, pairwise complete
    (a row counts for a pair when both values are present), as
    ``(by..., var1, var2, corr)``.  One aggregate with k*(k+1)/2 ``corr``."""
    cols = list(columns)
    by = list(by)
    aggs, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            n = f"c{i}_{cols.index(b)}"
            aggs.append(F.corr(_q(a).cast("double"), _q(b).cast("double")).alias(n))
            names.append((a, b, n))
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    pairs = []
    for a, b, n in names:
        pairs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(n).alias("corr")))
        if a != b:
            pairs.append(F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"), F.col(n).alias("corr")))
    return wide.select(*[_q(x) for x in by], F.inline(F.array(*pairs)))


def box_summary(df: DataFrame, columns) -> DataFrame:
    """Per column the quartiles (exact, linear), IQR, whisker ends (most
    extreme values inside 1.5 IQR of the box) and the outlier count.

    Quartiles come from the distributed exact quantile (driver sees a few
    numbers per column); whiskers and outliers from one more aggregate.
    """
    cols = list(columns)
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    spark = df.sparkSession
    qdf = spark.createDataFrame([(c, *[float(x) if x is not None else None for x in qs[c]]) for c in cols],
                                "column string, q1 double, median double, q3 double")
    long = _long(df, cols).join(F.broadcast(qdf), "column")  # one row per column: bounded
    iqr = F.col("q3") - F.col("q1")
    lo_f = F.col("q1") - 1.5 * iqr
    hi_f = F.col("q3") + 1.5 * iqr
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    return (long.groupBy("column", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.count_if(~inside).alias("n_outliers"),
                 F.count("*").alias("n"))
            .withColumn("iqr", F.col("q3") - F.col("q1")))


def outlier_rows(df: DataFrame, column: str, q1: float, q3: float) -> DataFrame:
    """The rows outside the whiskers of one column."""
    iqr = q3 - q1
    c = _q(column)
    return df.where((c < q1 - 1.5 * iqr) | (c > q3 + 1.5 * iqr))


LENGTH_PERCENTILES = (50, 75, 90, 95, 98, 99, 99.5, 99.9)


def length_stats(lengths: DataFrame, column: str = "length",
                 percentiles=LENGTH_PERCENTILES, round_to: int = 64) -> DataFrame:
    """A18 + A19: min, max, mean and exact linear percentiles of sequence
    lengths, plus the suggested padding length ``ceil(p / round_to) * round_to``
    (``round_to`` when p <= 0) for p95 and p99.  One row."""
    probs = [p / 100.0 for p in percentiles]
    qs = exact_quantiles(lengths, [column], probs)[column]
    base = lengths.agg(F.min(column).cast("double").alias("min"),
                       F.max(column).cast("double").alias("max"),
                       F.avg(column).alias("mean"),
                       F.count(column).alias("n"))
    cols = [F.col("*")]
    for p, q in zip(percentiles, qs):
        cols.append(F.lit(q).cast("double").alias(f"p{str(p).replace('.', '_')}"))
    out = base.select(*cols).withColumn("median", F.col("p50"))
    for p in (95, 99):
        c = F.col(f"p{p}")
        out = out.withColumn(f"max_len_p{p}",
                             F.when(c > 0, F.ceil(c / round_to) * round_to).otherwise(F.lit(round_to)).cast("long"))
    return out


def null_and_distinct_counts(df: DataFrame, columns=None, digits: int | None = None) -> DataFrame:
    """P11 + P12: per column the number of nulls (NaN included) and of distinct
    values, where a missing value counts as one more distinct value when
    present (pandas ``nunique(dropna=False)``).  One aggregate.  ``digits``
    counts floating values as distinct at that decimal resolution."""
    columns = list(columns or df.columns)
    aggs = []
    for c in columns:
        col = _q(c)
        t = dict(df.dtypes)[c]
        miss = (col.isNull() | F.isnan(col)) if t in ("double", "float") else col.isNull()
        key = F.round(col, digits) if (digits is not None and t in ("double", "float")) else col
        aggs.append(F.count_if(miss).alias(f"n_{c}"))
        aggs.append(F.count_distinct(F.when(~miss, key)).alias(f"d_{c}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`n_{c}`").alias("n_null"),
                     (F.col(f"`d_{c}`") + F.when(F.col(f"`n_{c}`") > 0, 1).otherwise(0)).alias("n_distinct"))
            for c in columns]
    return wide.select(F.inline(F.array(*rows)))
