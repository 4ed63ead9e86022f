"""Class weights and sampling.

Random choices use hash draws of (seed, key), so a sample does not change
with the partition layout or when a lost task is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.functions.randomness import hash_uniform
from wardline.operators.common import broadcast_if_bounded


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A20 + A21: per class ``n``, ``1/n`` (sampler weight), ``N/(k n)``
    (balanced class weight) and ``pos_weight = n_neg / n_pos`` (binary).
    The class table has one row per class; totals come from a window over it."""
    c = class_counts(df, label_col)
    w = Window.partitionBy()
    return (c.withColumn("_total", F.sum("n").over(w))
            .withColumn("_k", F.count(F.lit(1)).over(w))
            .withColumn("_neg", F.sum(F.when(F.col(label_col) == 0, F.col("n"))).over(w))
            .withColumn("_pos", F.sum(F.when(F.col(label_col) == 1, F.col("n"))).over(w))
            .select(label_col, "n",
                    (F.lit(1.0) / F.col("n")).alias("inverse_weight"),
                    (F.col("_total") / (F.col("_k") * F.col("n"))).alias("balanced_weight"),
                    (F.col("_neg") / F.col("_pos")).alias("pos_weight")))


def with_sample_weight(df: DataFrame, label_col: str = "label", kind: str = "inverse",
                       out_col: str = "weight") -> DataFrame:
    """Per-row weight from the class table (broadcast: one row per class)."""
    w = class_weights(df, label_col)
    col = {"inverse": "inverse_weight", "balanced": "balanced_weight"}[kind]
    return df.join(broadcast_if_bounded(w.select(label_col, F.col(col).alias(out_col))), label_col, "left")


def positive_counts(df: DataFrame, group_col: str = "split", label_col: str = "label") -> DataFrame:
    """Positives and totals per group."""
    return df.groupBy(group_col).agg(F.sum(label_col).cast("long").alias("n_positive"),
                                     F.count(F.lit(1)).alias("n"))


def stratified_quota(df: DataFrame, n: int, label_col: str = "label") -> DataFrame:
    """Per-class quota that sums to exactly ``n``: ``floor(n * n_c / N)`` plus
    one for the classes with the largest remainders (ties by class)."""
    c = class_counts(df, label_col)
    w = Window.partitionBy()
    exact = F.lit(float(n)) * F.col("n") / F.sum("n").over(w)
    c = c.withColumn("_exact", exact).withColumn("_base", F.floor("_exact").cast("long"))
    c = c.withColumn("_rem", F.col("_exact") - F.col("_base"))
    c = c.withColumn("_left", F.lit(n) - F.sum("_base").over(w))
    c = c.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("_rem"), F.col(label_col))))
    return c.select(label_col, (F.col("_base") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0))
                    .alias("quota"))


def stratified_sample(df: DataFrame, n: int, seed: int = 0, label_col: str = "label",
                      id_col: str = "RecordID") -> DataFrame:
    """M1 (W7): exactly ``n`` rows, classes in proportion (largest remainder).

    Rows are ranked inside their class by a hash of (seed, id).  The rank
    filter uses the largest quota as a literal, which Spark runs as a group
    limit before the shuffle (each task ships at most that many rows per
    class), then the exact per-class quota is applied.
    """
    quota = stratified_quota(df, n, label_col)
    q_rows = quota.collect()  # one row per class
    max_q = max([r["quota"] for r in q_rows] or [0])
    w = Window.partitionBy(label_col).orderBy(hash_uniform(seed, id_col), id_col)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= F.lit(int(max_q)))
    quota_local = df.sparkSession.createDataFrame(q_rows, quota.schema)
    return (ranked.join(broadcast_if_bounded(quota_local), label_col)
            .where(F.col("_rank") <= F.col("quota"))
            .drop("_rank", "quota"))


def n_per_class(df: DataFrame, n: int, seed: int = 0, label_col: str = "label", id_col: str = "RecordID") -> DataFrame:
    """M3: ``n`` rows of every class in hash order (all rows of a smaller class)."""
    w = Window.partitionBy(label_col).orderBy(hash_uniform(seed, id_col), id_col)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= F.lit(n)).drop("_rank")


def dense_index_by_class(df: DataFrame, label_col: str = "label", id_col: str = "RecordID", seed: int = 0,
                         class_sizes: dict | None = None, rows_per_group: int = 1_000_000) -> DataFrame:
    """Index ``1..n_c`` inside each class in hash order, without holding a
    class in one task: rows fall into hash buckets (about ``rows_per_group``
    rows each), get a row number inside (class, bucket), and add the count of
    the buckets before theirs (a table of classes x buckets rows)."""
    if class_sizes is None:
        class_sizes = {r[label_col]: r["n"] for r in class_counts(df, label_col).collect()}
    n_b = max(1, -(-max(class_sizes.values() or [1]) // rows_per_group))
    u = hash_uniform(seed, id_col)
    d = df.withColumn("_u", u).withColumn("_bk", F.least(F.floor(F.col("_u") * n_b), F.lit(n_b - 1)).cast("int"))
    counts = d.groupBy(label_col, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(label_col).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label_col, "_bk", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(label_col, "_bk").orderBy("_u", id_col)
    return (d.join(broadcast_if_bounded(offsets), [label_col, "_bk"])
            .withColumn("_idx", (F.col("_off") + F.row_number().over(w_in)).cast("long"))
            .drop("_u", "_bk", "_off"))


def weighted_sample_with_replacement(df: DataFrame, n_draws: int, seed: int = 0,
                                     label_col: str = "label", id_col: str = "RecordID") -> DataFrame:
    """M2: ``n_draws`` draws with replacement, each row weighted by ``1/n_class``
    (so every class is drawn with equal probability).

    Two-level draw, so nothing is sorted globally: draw ``d`` picks a class
    uniformly from a hash, then an index inside the class; rows get a dense
    index inside their class from a row number by class (rank by hash of
    the id).  Draws and rows meet by an equi-join on (class, index).
    Returns one row per draw ``(draw, <row columns>)``.
    """
    spark = df.sparkSession
    classes = class_counts(df, label_col)
    k_rows = classes.orderBy(label_col).collect()  # one row per class
    k = len(k_rows)
    if k == 0:
        return df.limit(0).withColumn("draw", F.lit(0).cast("long"))
    labels = [r[label_col] for r in k_rows]
    sizes = [r["n"] for r in k_rows]
    draws = spark.range(n_draws).withColumnRenamed("id", "draw")
    cls_idx = F.floor(hash_uniform(seed, "draw", F.lit(0)) * k).cast("int")
    lab_arr = F.array(*[F.lit(x) for x in labels])
    size_arr = F.array(*[F.lit(int(x)) for x in sizes])
    draws = (draws.withColumn("_ci", cls_idx)
             .withColumn(label_col, F.element_at(lab_arr, F.col("_ci") + 1))
             .withColumn("_idx", F.floor(hash_uniform(seed, "draw", F.lit(1))
                                         * F.element_at(size_arr, F.col("_ci") + 1)).cast("long") + 1)
             .drop("_ci"))
    indexed = dense_index_by_class(df, label_col, id_col, seed, dict(zip(labels, sizes)))
    return draws.join(indexed, [label_col, "_idx"]).drop("_idx")
