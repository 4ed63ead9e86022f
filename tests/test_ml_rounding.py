import numpy as np
from pyspark.sql import functions as F

from wardline.operators.ml import grid_search_lr, random_forest, vectors
from wardline.plans.registry import rounded


def test_refit_uses_the_penalty_of_all_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(400)], "RecordID long, x array<double>, label int")
    model, scores = grid_search_lr(vectors(df, "x"), [1.0], k=4)
    w = np.zeros(4)  # Newton steps on sum of log-losses + |w|^2 / (2 C), intercept free
    a = np.hstack([x, np.ones((400, 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        pen = np.diag([1.0, 1.0, 1.0, 0.0])
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + pen, a.T @ (p - y) + pen @ w)
    assert np.allclose(model.coefficients.toArray(), w[:3], atol=1e-3)
    assert len(scores) == 1


def test_deep_forests_are_refused():
    import pytest

    with pytest.raises(ValueError):
        random_forest(max_depth=31)


def test_rounding_reaches_nested_values(spark):
    df = spark.range(1).select(F.array(F.array(F.lit(1.23456789))).alias("a"), F.array(F.struct(F.lit(2.00000049).alias("t"), F.lit(3).alias("z"))).alias("s"),
                               F.lit(None).cast("struct<x:double>").alias("n"))
    r = rounded(df).collect()[0]
    assert r["a"] == [[1.234568]] and r["s"][0]["t"] == 2.0 and r["s"][0]["z"] == 3 and r["n"] is None
