"""Evaluation reports (M11-M15, M17, A21) on driver tables.

Score source: a document's standardised character count (F5) used as a
logit for its quality label; embeddings with their class folded to binary.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.metrics import classification_report, confusion_matrix, silhouette_sq_euclidean
from wardline.operators.sample import class_weights
from wardline.operators.scale import apply_standard, fit_standard
from wardline.plans.registry import r, register, rounded
from wardline.sources.tables import embeddings_as_vectors, labels_as_outcomes, read_table


def doc_logits(spark, sf_dir):
    lab = labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "n_chars"])
    d = (lab.join(docs.withColumnRenamed("doc_id", "RecordID"), "RecordID")
         .select("RecordID", "label", F.col("n_chars").cast("double").alias("logit")))
    return apply_standard(d, fit_standard(d, ["logit"]))


_DOC_SQL = """d AS (SELECT l.doc_id, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS n
         FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
  st AS (SELECT avg(n) AS mu, stddev_pop(n) AS sd FROM d),
  x AS (SELECT y, (n - mu) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END AS x FROM d, st),
  p AS (SELECT y, x, 1.0 / (1.0 + exp(-x)) AS p FROM x)"""

SQL_SCORE_METRICS = f"""WITH {_DOC_SQL},
  cw AS (SELECT CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) / count(*) FILTER (WHERE y = 1) AS pw FROM d),
  base AS (
    SELECT avg(pw * y * (ln(1 + exp(-abs(-x))) + greatest(-x, 0.0))
               + (1 - y) * (ln(1 + exp(-abs(x))) + greatest(x, 0.0))) AS loss,
           avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1 ELSE 0 END) = y THEN 1.0 ELSE 0.0 END) AS accuracy,
           count(*) FILTER (WHERE y = 0 AND p <= 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p > 0.5) AS fp,
           count(*) FILTER (WHERE y = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p > 0.5) AS tp
    FROM p, cw),
  sc AS (SELECT p AS score, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY p),
  asc_ AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM sc),
  desc_ AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_cum,
                      sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM sc),
  auc AS (SELECT sum(pos * (neg_cum - neg) + 0.5 * pos * neg) AS u, sum(pos) AS n_pos, sum(neg) AS n_neg FROM asc_),
  ap AS (SELECT sum(pos * pos_cum / (pos_cum + neg_cum)) AS ap FROM desc_)
SELECT {r('loss')} AS loss, {r('accuracy')} AS accuracy, tn, fp, fn, tp,
       CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
       {r('u / (n_pos * n_neg)')} AS auroc, {r('ap / n_pos')} AS average_precision
FROM base, auc, ap"""


@register("score_metrics", SQL_SCORE_METRICS)
def q_score_metrics(spark, sf_dir):
    """M11-M15 + A21: BCE with pos_weight, accuracy, confusion cells, exact
    ROC-AUC (ties = 1/2) and step-wise AP for a logit column against labels."""
    d = doc_logits(spark, sf_dir)
    pw = class_weights(d).where("label = 1").select("pos_weight").first()[0]
    rep = classification_report(d, "logit", "label", pos_weight=pw)
    return rounded(rep.select("loss", "accuracy", "tn", "fp", "fn", "tp",
                              F.col("n_pos").cast("long").alias("n_pos"),
                              F.col("n_neg").cast("long").alias("n_neg"), "auroc", "average_precision"))


@register("confusion_matrix", f"""WITH {_DOC_SQL},
  cells AS (SELECT a.label, b.pred FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(pred))
SELECT c.label, c.pred, count(p.y) AS count
FROM cells c LEFT JOIN p ON p.y = c.label AND (CASE WHEN p.p > 0.5 THEN 1 ELSE 0 END) = c.pred
GROUP BY c.label, c.pred""")
def q_confusion_matrix(spark, sf_dir):
    """M11 + F14: 2x2 confusion cells of sigmoid(logit) > 0.5, labels fixed to 0 and 1."""
    d = doc_logits(spark, sf_dir)
    pred = (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))) > 0.5).cast("int")
    return confusion_matrix(d.withColumn("pred", pred), "label", "pred")


@register("embedding_silhouette", f"""WITH e AS (
    SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE 0 END AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  pairs AS (
    SELECT a.vec_id, a.c AS ca, b.c AS cb, list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d
    FROM e a JOIN e b ON a.vec_id <> b.vec_id),
  per AS (SELECT vec_id, ca, cb, avg(d) AS md FROM pairs GROUP BY vec_id, ca, cb),
  sizes AS (SELECT c, count(*) AS m FROM e GROUP BY c),
  s AS (
    SELECT e.vec_id,
      CASE WHEN sz.m <= 1 THEN 0.0 ELSE
        (min(per.md) FILTER (WHERE per.cb <> e.c) - max(per.md) FILTER (WHERE per.cb = e.c))
        / greatest(min(per.md) FILTER (WHERE per.cb <> e.c), max(per.md) FILTER (WHERE per.cb = e.c)) END AS s
    FROM e JOIN per ON per.vec_id = e.vec_id JOIN sizes sz ON sz.c = e.c
    GROUP BY e.vec_id, e.c, sz.m)
SELECT {r('avg(s)')} AS silhouette, count(*) AS n FROM s""")
def q_embedding_silhouette(spark, sf_dir):
    """Silhouette of embeddings by (binary) label, squared Euclidean
    distance, exact from per-class sums (the oracle uses all pairs)."""
    emb = embeddings_as_vectors(read_table(spark, sf_dir, "embeddings"))
    return rounded(silhouette_sq_euclidean(emb, "embedding", "label"))
