"""Histograms: values stay where they are."""

import numpy as np

from wardline.operators import explore
from wardline.operators.explore import histogram


def test_ranges_go_to_the_values(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(None if i % 7 == 0 else i % 3, float(np.round(rng.normal(), 2)), None if i % 4 else 2.5) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = histogram(df, ["a", "b"], bins=5)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" in plan  # was a shuffle of all values by a few keys
        by_group = sorted(map(str, histogram(df, ["a", "b"], bins=5, by=["g"]).collect()))
        monkeypatch.setattr(explore, "broadcast_if_bounded", lambda x: x)  # more groups than a broadcast may have
        assert sorted(map(str, got.collect())) == sorted(map(str, histogram(df, ["a", "b"], bins=5).collect()))
        assert by_group == sorted(map(str, histogram(df, ["a", "b"], bins=5, by=["g"]).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    a = np.array([r[1] for r in rows])
    assert [r["count"] for r in got.where("column = 'a'").orderBy("bin").collect()] == list(np.histogram(a, bins=5)[0])
    assert histogram(df.limit(0), ["a", "b"]).collect() == []
