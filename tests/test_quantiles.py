import numpy as np
import pandas as pd

from wardline.operators.quantiles import exact_quantiles


def test_refinement_matches_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=5000),
                        "b": np.round(rng.exponential(size=5000), 1),
                        "c": np.concatenate([np.full(4000, 3.0), rng.normal(size=1000)])})
    df = spark.createDataFrame(pdf)
    ps = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    # a tiny exact limit forces several refinement rounds and the tie path
    got = exact_quantiles(df, ["a", "b", "c"], ps, max_exact=50, n_buckets=8)
    for c in "abc":
        exp = [float(np.quantile(pdf[c], p)) for p in ps]
        assert np.allclose(exp, got[c], rtol=0, atol=1e-12), (c, exp, got[c])


def test_targets_on_both_sides_of_a_heavy_value(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=3000)
    pdf = pd.DataFrame({"low": np.concatenate([np.full(6000, base.min() - 1), base]),
                        "mid": np.concatenate([np.full(6000, np.median(base)), base]),
                        "high": np.concatenate([np.full(6000, base.max() + 1), base]),
                        "two": np.concatenate([np.full(3000, -0.5), np.full(3000, 0.5), base])})
    ps = [0.0, 0.002, 0.005, 0.1, 0.16, 0.3, 0.5, 0.7, 0.84, 0.9, 0.995, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), list(pdf), ps, max_exact=400, n_buckets=16)
    for c in pdf:
        assert np.allclose(got[c], [np.quantile(pdf[c], p) for p in ps], rtol=0, atol=1e-12), c
