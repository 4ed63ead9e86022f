"""Mixing sources to target weights by Poisson replication (operator 8).

A document of source ``s`` is to occur ``rate(s) = weight(s) * total / n(s)``
times on average.  Its number of copies is the inverse of the Poisson
distribution with that mean at a number in [0, 1) that a hash of the seed, the
row's digest and its number among equal rows gives: any rerun draws alike, and
every row draws for itself.  Copies are spread by a second hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import fresh, stored, unpacked

#: equal rows that are numbered in one go
RUN = 10_000
#: rates above this are drawn as several independent parts of at most this mean
PART_RATE = 32
#: inversion looks at so many counts; the chance of more, at a mean of 32, is below 2**-53
MOST = 110


def unit(*parts):
    """A number in [0, 1) from 52 bits of the MD5 of the joined parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def source_rates(docs: DataFrame, weights: dict[str, float] | None, total: float | None, source_col: str) -> DataFrame:
    """``source, n, rate`` per source; without weights all sources weigh alike.

    Weights of absent sources are ignored and the others scaled to sum to one;
    sources without a weight get none."""
    n = docs.groupBy(F.col(source_col).alias("_source")).agg(F.count("*").alias("_n"))
    n = stored(n, "sources")
    if weights is None:
        w = n.withColumn("_w", F.lit(1.0))
    else:
        rows = n.sparkSession.createDataFrame(list(weights.items()), "_name string, _w double")
        w = n.join(rows, n["_source"].eqNullSafe(rows["_name"]), "left").drop("_name").na.fill(0.0, ["_w"])
    sums = w.agg(F.sum("_w"), F.sum("_n")).first()
    scale = (total if total is not None else sums[1] or 0) / (sums[0] or 1.0)
    return w.select("_source", (F.col("_w") * F.lit(float(scale)) / F.col("_n")).alias("_rate"))


def poisson_inverse(u, rate):
    """Least k with P(X <= k) > u for X ~ Poisson(rate), rate at most 32."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))
    step = lambda s, i: F.when(s["c"] > u, s).otherwise(
        F.struct((s["p"] * rate / i).alias("p"), (s["c"] + s["p"] * rate / i).alias("c"), i.cast("int").alias("k")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step)["k"]


def row_digest(docs: DataFrame):
    """MD5 of all columns of a row, as text; nulls and empty texts differ."""
    def text(f: T.StructField):
        c = F.col(f"`{f.name}`")
        simple = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        return F.coalesce(c.cast("string") if simple else F.to_json(F.struct(c)), F.lit("\x00"))

    return F.md5(F.concat_ws("\x1f", *[text(f) for f in docs.schema.fields]).cast("binary"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``_row, _key``) with ``_n``, the number of a row among those of
    its key, from 0.  Rows of one key are equal, so a key that repeats is
    counted, not gathered, and its numbers are dealt out in runs of ``RUN``."""
    counts = rows.groupBy("_key").agg(F.count("*").alias("_m")).where(F.col("_m") > 1).select(F.col("_key").alias("_again"))
    again = stored(counts, "equal-rows")
    if again.isEmpty():
        return rows.withColumn("_n", F.lit(0).cast("long"))
    same = rows["_key"] == again["_again"]
    once = rows.join(again, same, "left_anti").withColumn("_n", F.lit(0).cast("long"))
    runs = (rows.join(again, same, "left_semi").groupBy("_key").agg(F.first("_row").alias("_row"), F.count("*").alias("_m"))
            .withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, F.lit(RUN).cast("long")))))
    each = (runs.repartition("_key", "_start")
            .withColumn("_n", F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + RUN, F.col("_m")) - 1))))
    return once.unionByName(each.select("_row", "_key", "_n"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = 8,
                source_col: str = "source", copy_col: str = "copy_no", order_col: str = "shuffle_key") -> DataFrame:
    """Copies of the rows of ``docs`` in a global random order.

    All columns are kept; ``copy_col`` numbers a row's copies from 0 and
    ``order_col`` is the hash by which the result is dealt out and sorted
    (input columns of these names are replaced).  A null source is a source of
    its own; rows without an id, with a repeated id and equal rows each draw
    for themselves; an empty table gives an empty result.
    """
    docs = docs.drop(copy_col, order_col)
    rates = source_rates(docs, weights, total, source_col)
    rows = numbered(docs.withColumn(key := fresh(docs, "_key"), row_digest(docs)).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_key")))
    name = F.concat_ws("|", "_key", "_n")
    parts = F.greatest(F.ceil(F.col("_rate") / PART_RATE), F.lit(1)).cast("int")
    drawn = (rows.join(rates, rows["_row"][source_col].eqNullSafe(rates["_source"]))
             .withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
             .withColumn("_u", unit(F.lit(seed), name, F.col("_part"))).withColumn("_mean", F.col("_rate") / F.col("_parts"))
             .withColumn("_k", poisson_inverse(F.col("_u"), F.col("_mean"))).where(F.col("_k") > 0)
             .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
             .withColumn("_copy", F.col("_part").cast("long") * (MOST + 1) + F.col("_i"))
             .withColumn("_order", F.md5(F.concat_ws("|", F.lit("order"), F.lit(seed), name, F.col("_copy")).cast("binary"))))
    dealt = drawn.select("_row", "_copy", "_order").repartition("_order").sortWithinPartitions("_order")
    return unpacked(dealt, docs.columns, F.col("_copy").alias(copy_col), F.col("_order").alias(order_col))


#: the same draw in SQL, for all sources alike and one part per document
ORACLE = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, CAST((SELECT sum(n) FROM n) AS DOUBLE) / (SELECT count(*) FROM n) / n AS rate FROM n),
cdf AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
        FROM rates, (SELECT unnest(range(0, 111)) AS k)),
d AS (SELECT *, md5(concat_ws(chr(31), doc_id, coalesce(text, chr(0)), coalesce(lang, chr(0)), coalesce(source, chr(0)), n_chars)) AS h FROM documents),
e AS (SELECT *, h || '|' || (row_number() OVER (PARTITION BY h) - 1) AS name FROM d),
u AS (SELECT name, source, CAST(('0x' || substr(md5('8|' || name || '|0'), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM e),
k AS (SELECT u.name, count(*) FILTER (WHERE cdf.c <= u.u) AS k FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source GROUP BY u.name)
SELECT e.doc_id, e.text, e.lang, e.source, e.n_chars, c.copy_no, md5('order|8|' || e.name || '|' || c.copy_no) AS shuffle_key
FROM e JOIN (SELECT name, unnest(range(0, k)) AS copy_no FROM k) c USING (name)
"""
