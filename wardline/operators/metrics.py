"""Exact evaluation metrics as distributed aggregates.

ROC-AUC and average precision need running sums of positives/negatives over
the score order.  Scores are first reduced to distinct values (one row per
distinct score, map-side combined), then scanned in score ranges: each range
gets its running sums from a window inside the range, and an offset from the totals of the ranges before it (one row per range).  No
task ever holds more than one range, and ties are whole rows, so heavy
score ties cost nothing.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.operators.common import attach_row
from wardline.session import cut_lineage


#: distinct keys of one range of a running sum, and ranges at most
RANGE_ROWS, MOST_RANGES = 100_000, 20_000


def running_sums(df: DataFrame, key: str, cols, descending: bool = False,
                 n_buckets: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``key`` order (ascending or
    descending), computed range by range.  ``df`` must hold one row per key.

    The rows are dealt to ranges of the key once and stored with the number of
    their range; the number of ranges follows the number of keys, so a range
    stays small at any size.  Offsets come from one row per range."""
    df = cut_lineage(df)
    n = n_buckets or min(max(math.ceil(df.count() / RANGE_ROWS), 1), MOST_RANGES)
    order = F.col(key).desc() if descending else F.col(key).asc()
    d = df if n == 1 else df.repartitionByRange(n, order)
    d = d.withColumn("_bk", F.lit(0) if n == 1 else F.spark_partition_id())
    if n > 1:
        d = cut_lineage(d)  # the ranges are drawn from a sample: keep them
    w_in = Window.partitionBy("_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = d.groupBy("_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    w_off = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_bk", *[F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}")
                                     for c in cols])
    out = d.join(F.broadcast(offsets), "_bk")  # MOST_RANGES rows at most
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"_o_{c}") + F.sum(c).over(w_in))
    return out.drop("_bk", *[f"_o_{c}" for c in cols])


def score_table(df: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """Distinct scores with their positive / negative counts."""
    y = F.col(label_col).cast("long")
    return (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(score_col).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def auroc_ap(df: DataFrame, score_col: str = "score", label_col: str = "label",
             n_buckets: int | None = None) -> DataFrame:
    """M12 + M13: exact ROC-AUC (ties count one half) and step-wise average
    precision ``sum(dR * P)`` over thresholds at the distinct scores (higher
    score = more positive).  One row ``(n_pos, n_neg, auroc, average_precision)``.

    One ascending scan serves both: what lies at a score or above it is the
    total less what lies below it, and the totals are sums of the same rows."""
    asc = running_sums(score_table(df, score_col, label_col), "score", ["pos", "neg"], n_buckets=n_buckets)
    whole = asc.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    below_pos, below_neg = F.col("pos_cum") - F.col("pos"), F.col("neg_cum") - F.col("neg")
    at_least_pos, at_least_neg = F.col("n_pos") - below_pos, F.col("n_neg") - below_neg
    rows = attach_row(asc, whole)
    return rows.agg(
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
        F.sum(F.col("pos") * below_neg + 0.5 * F.col("pos") * F.col("neg")).alias("_u"),
        F.sum(F.col("pos") * at_least_pos / (at_least_pos + at_least_neg)).alias("_ap")).select(
        "n_pos", "n_neg",
        (F.col("_u") / (F.col("n_pos") * F.col("n_neg"))).alias("auroc"),
        (F.col("_ap") / F.col("n_pos")).alias("average_precision"))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Counts for labels fixed to 0 and 1, all four cells present
    (one aggregate, then four rows)."""
    y, p = F.col(label_col), F.col(pred_col)
    wide = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    cells = [F.struct(F.lit(a).alias(label_col), F.lit(b).alias(pred_col), F.col(f"c{a}{b}").alias("count"))
             for a in (0, 1) for b in (0, 1)]
    return wide.select(F.inline(F.array(*cells)))


def confusion_array(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """M11 as ``ARRAY<ARRAY<LONG>>`` (rows = true label) for the JSON sink."""
    y, p = F.col(label_col), F.col(pred_col)
    return df.agg(F.array(F.array(F.count_if((y == 0) & (p == 0)), F.count_if((y == 0) & (p == 1))),
                          F.array(F.count_if((y == 1) & (p == 0)), F.count_if((y == 1) & (p == 1))))
                  .alias("confusion_matrix"))


def sigmoid(x):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def softplus(x):
    """log(1 + exp(x)) without overflow."""
    return F.log1p(F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0))


def bce_with_logits(logit, label, pos_weight: float | None = None):
    """M15 per row: ``pw*y*softplus(-x) + (1-y)*softplus(x)``."""
    y = label.cast("double")
    pw = F.lit(float(pos_weight)) if pos_weight is not None else F.lit(1.0)
    return pw * y * softplus(-logit) + (F.lit(1.0) - y) * softplus(logit)


def threshold(p, cut: float = 0.5):
    """hard prediction ``p > cut`` (0.5 itself is negative)."""
    return (p > F.lit(cut)).cast("int")


def classification_report(df: DataFrame, logit_col: str = "logit", label_col: str = "label",
                          pos_weight: float | None = None, n_buckets: int | None = None) -> DataFrame:
    """M11-M15 together: loss (mean BCE on logits), accuracy of ``sigmoid > 0.5``,
    ROC-AUC and AP of the probability, and the confusion cells.  One row."""
    x = F.col(logit_col).cast("double")
    y = F.col(label_col)
    scored = df.select(x.alias("_x"), y.alias("_y"), sigmoid(x).alias("_p"))
    pred = threshold(F.col("_p"))
    base = scored.agg(
        F.avg(bce_with_logits(F.col("_x"), F.col("_y"), pos_weight)).alias("loss"),
        F.avg((pred == F.col("_y")).cast("double")).alias("accuracy"),
        F.count_if((F.col("_y") == 0) & (pred == 0)).alias("tn"),
        F.count_if((F.col("_y") == 0) & (pred == 1)).alias("fp"),
        F.count_if((F.col("_y") == 1) & (pred == 0)).alias("fn"),
        F.count_if((F.col("_y") == 1) & (pred == 1)).alias("tp"))
    ranks = auroc_ap(scored, "_p", "_y", n_buckets)
    return attach_row(base, ranks)


def silhouette_sq_euclidean(df: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """M17 with squared Euclidean distance, exact and without pairs.

    The mean squared distance from x to the points of class c is
    ``|x|^2 - 2 x.mu_c + mean_c(|y|^2)`` for vectors less the mean of all
    points (so that nothing cancels far from the origin); per-class sums (count,
    vector sum, sum of squared norms; one row per class) give every point's a
    (own class, excluding itself) and b (nearest other class).  Returns one row
    ``(silhouette, n)``; points alone in their class score 0, points without a
    vector or a class are left out.
    """
    raw = (df.select(F.col(label_col).alias("_c"),
                     F.transform(vec_col, lambda x: x.cast("double")).alias("_v"))
           .where(F.col("_c").isNotNull() & F.col("_v").isNotNull()))
    # a group, not a global aggregate: an empty table has no row here
    center = raw.groupBy(F.lit(1).alias("_one")).agg(vector_to_array(Summarizer.mean(array_to_vector("_v"))).alias("_center"))
    norm2 = F.aggregate("_v", F.lit(0.0), lambda acc, x: acc + x * x)
    pts = (attach_row(raw, center)
           .select("_c", F.zip_with("_v", "_center", lambda x, m: x - m).alias("_v"))
           .withColumn("_n2", norm2))
    cls = pts.groupBy("_c").agg(
        vector_to_array(Summarizer.sum(array_to_vector("_v"))).alias("_sum"),
        F.count(F.lit(1)).alias("_m"), F.sum("_n2").alias("_q"))
    classes = cls.agg(F.collect_list(F.struct("_c", "_sum", "_m", "_q")).alias("_cls"))  # one row per class
    joined = attach_row(pts, classes)  # single row holding the class table

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, t: acc + t)

    per = joined.select("_c", "_v", "_n2", F.transform("_cls", lambda c: F.struct(
        c["_c"].alias("c"), c["_m"].alias("m"),
        # total squared distance from x to all points of class c (x itself adds 0)
        (c["_m"] * F.col("_n2") - 2 * dot(F.col("_v"), c["_sum"]) + c["_q"]).alias("tot"))).alias("_d"))
    own = F.filter("_d", lambda d: d["c"] == F.col("_c"))[0]
    others = F.filter("_d", lambda d: d["c"] != F.col("_c"))
    a = own["tot"] / (own["m"] - 1)
    b = F.array_min(F.transform(others, lambda d: d["tot"] / d["m"]))
    s = F.when(own["m"] <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return per.select(s.alias("_s")).agg(F.avg("_s").alias("silhouette"), F.count(F.lit(1)).alias("n"))


def best_epoch(history: DataFrame, metric: str = "auroc", epoch_col: str = "epoch",
               patience: int | None = None, run_cols=()) -> DataFrame:
    """Per run, the epoch with the best validation metric, and where
    early stopping with ``patience`` would stop (first epoch after which
    ``patience`` epochs brought no improvement).  Windows per run."""
    run_cols = list(run_cols)
    w = Window.partitionBy(*run_cols).orderBy(epoch_col) if run_cols else Window.orderBy(epoch_col)
    h = history.withColumn("_best_so_far", F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_improved", F.col(metric) >= F.col("_best_so_far"))
    h = h.withColumn("_last_improve", F.max(F.when(F.col("_improved"), F.col(epoch_col)))
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    grp = history.groupBy(*run_cols) if run_cols else history.groupBy()
    best = grp.agg(F.max_by(epoch_col, F.struct(F.col(metric), -F.col(epoch_col))).alias("best_epoch"),
                   F.max(metric).alias(f"best_{metric}"))
    if patience is None:
        return best
    stop = (h.where(F.col(epoch_col) - F.col("_last_improve") >= patience)
            .groupBy(*run_cols).agg(F.min(epoch_col).alias("stop_epoch")))
    return best.join(stop, run_cols, "left") if run_cols else attach_row(best, stop)
