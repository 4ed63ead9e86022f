import math

import pandas as pd

from wardline.operators.features import fill_features, stat_features
from wardline.operators.impute import fill_values, fit_medians, forward_fill


def test_forward_fill_then_median(spark):
    vals = [None, 5.0, None, None, 7.0, None]
    rows = [(1, t, v) for t, v in enumerate(vals)] + [(2, t, None) for t in range(3)]
    df = spark.createDataFrame(rows, "RecordID long, Time int, x double")
    out = fill_values(forward_fill(df, ["x"]), {"x": 4.0})
    got = {(r.RecordID, r.Time): r.x for r in out.collect()}
    assert [got[(1, t)] for t in range(6)] == [4, 5, 5, 5, 7, 7]
    assert [got[(2, t)] for t in range(3)] == [4, 4, 4]  # no leak across ids


def test_stat_features_match_pandas(spark):
    series = {1: [1, 2, 10], 2: [3, 3, 3], 3: [1, 2], 4: [5], 5: []}
    rows = [(k, t, float(v)) for k, vs in series.items() for t, v in enumerate(vs)] + [(5, 0, None)]
    df = spark.createDataFrame(rows, "RecordID long, Time int, x double")
    got = {r.RecordID: r for r in stat_features(df, ["x"], []).collect()}
    for k, vs in series.items():
        s = pd.Series(vs, dtype=float)
        for stat, exp in (("mean", s.mean()), ("std", s.std()), ("skew", s.skew())):
            v = got[k][f"x_{stat}"]
            if exp is None or (isinstance(exp, float) and math.isnan(exp)):
                assert v is None, (k, stat, v)
            else:
                assert abs(v - exp) < 1e-9, (k, stat, v, exp)


def test_median_fill_drops_unfillable(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, None), (3, None, None)], "RecordID long, a double, b double")
    other = spark.createDataFrame([(9, None, 5.0)], "RecordID long, a double, b double")
    train, others, med = fill_features(df, {"val": other})
    assert med["a"] == 2.0 and med["b"] is None
    assert "b" not in train.columns
    assert {r.RecordID: r.a for r in train.collect()} == {1: 1.0, 2: 3.0, 3: 2.0}
    assert others["val"].first().a == 2.0


def test_exact_median_even_count(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4]], "a double")
    assert fit_medians(df, ["a"]) == {"a": 2.5}
