import pytest
import math

import numpy as np
from pyspark.sql import functions as F

from wardline.operators.metrics import auroc_ap, bce_with_logits, confusion_matrix, silhouette_sq_euclidean
from wardline.operators.sample import stratified_sample, weighted_sample_with_replacement


def _auc(spark, scores, labels, n_buckets=4):
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")
    return auroc_ap(df, "score", "label", n_buckets=n_buckets).first()


def test_auroc_ap_example(spark):
    r = _auc(spark, [0.1, 0.4, 0.35, 0.8], [0, 0, 1, 1])
    assert abs(r.auroc - 0.75) < 1e-12 and abs(r.average_precision - 0.8333333333) < 1e-9
    r = _auc(spark, [0.5] * 4, [0, 1, 0, 0])
    assert r.auroc == 0.5 and abs(r.average_precision - 0.25) < 1e-12


def test_auroc_brute_force_and_symmetry(spark):
    rng = np.random.default_rng(0)
    s = np.round(rng.normal(size=300), 1)
    y = (rng.random(300) < 0.3).astype(int)
    r = _auc(spark, s, y, n_buckets=7)
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(r.auroc - brute) < 1e-12
    # step-wise AP by brute force over distinct thresholds
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        ap += (np.sum(y[s == t]) / y.sum()) * (np.sum(y[sel]) / sel.sum())
    assert abs(r.average_precision - ap) < 1e-12
    assert abs(_auc(spark, -s, y, n_buckets=5).auroc - (1 - brute)) < 1e-12


def test_confusion_and_bce(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 0)], "label int, pred int")
    got = {(r.label, r.pred): r["count"] for r in confusion_matrix(df).collect()}
    assert got == {(0, 0): 2, (0, 1): 1, (1, 0): 0, (1, 1): 1}
    one = df.sparkSession.createDataFrame([(0.0, 1)], "x double, y int")
    v = one.select(bce_with_logits(F.col("x"), F.col("y"), 3.0).alias("l")).first().l
    assert abs(v - 3 * math.log(2)) < 1e-12


def test_silhouette_matches_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3)) + np.repeat([[0, 0, 0], [2, 2, 0]], 20, axis=0)
    lab = np.repeat([0, 1], 20)
    df = spark.createDataFrame([(x[i].tolist(), int(lab[i])) for i in range(40)], "embedding array<double>, label int")
    got = silhouette_sq_euclidean(df).first().silhouette
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(40):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = d[i, ~own].mean()
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9


def test_stratified_sample_exact_size(spark):
    df = spark.createDataFrame([(i, 1 if i < 7 else 0) for i in range(10)], "RecordID long, label int")
    for seed in range(5):
        out = stratified_sample(df, 5, seed=seed).collect()
        assert len(out) == 5
        assert sorted(r.label for r in out).count(1) in (3, 4)


def test_weighted_draws(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(100)], "RecordID long, label int")
    out = weighted_sample_with_replacement(df, 2000, seed=3).toPandas()
    assert len(out) == 2000
    assert 0.4 < out["label"].mean() < 0.6  # classes drawn equally often


def test_dense_index_by_class_is_a_permutation(spark):
    from wardline.operators.sample import dense_index_by_class
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "RecordID long, label int")
    out = dense_index_by_class(df, rows_per_group=40).toPandas()
    for lab, g in out.groupby("label"):
        assert sorted(g["_idx"]) == list(range(1, len(g) + 1))


def plain_silhouette(points, labels):
    points, labels = np.asarray(points), np.asarray(labels)
    out = []
    for x, c in zip(points, labels):
        d = ((points - x) ** 2).sum(axis=1)
        if (labels == c).sum() == 1:
            out.append(0.0)
            continue
        a = d[labels == c].sum() / ((labels == c).sum() - 1)
        b = min(d[labels == k].mean() for k in set(labels) - {c})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouette_far_from_the_origin(spark):
    rng = np.random.default_rng(3)
    labels = [0] * 20 + [1] * 15 + [2]
    points = rng.normal(size=(36, 5)) + np.array(labels)[:, None]
    want = plain_silhouette(points, labels)
    for far in (0.0, 1e7):
        rows = [([float(v) for v in p], c) for p, c in zip(points + far, labels)] + [(None, 1), ([0.0] * 5, None)]
        df = spark.createDataFrame(rows, "embedding array<double>, label int")
        got = silhouette_sq_euclidean(df).first()
        assert got.n == 36 and got.silhouette == pytest.approx(want, abs=1e-6)


def test_silhouette_of_an_empty_table(spark):
    got = silhouette_sq_euclidean(spark.createDataFrame([], "embedding array<float>, label int")).first()
    assert (got.silhouette, got.n) == (None, 0)
