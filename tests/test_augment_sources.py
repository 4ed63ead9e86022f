import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from wardline.operators.augment import (
    feature_masking, grid_views, info_nce, mean_pool, segment_permutation, sinusoid, time_masking,
)
from wardline.sources.records import load_record_files


def _grid(spark, n_ids=4, t=49, f=6):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=(t, f)).round(3).tolist()) for i in range(n_ids)]
    return spark.createDataFrame(rows, "RecordID long, x array<array<double>>")


def test_time_mask_is_one_contiguous_block(spark):
    g = _grid(spark)
    out = g.select("x", time_masking("x", F.col("RecordID"), 0.15, seed=1).alias("m")).collect()
    for r in out:
        zero_rows = [i for i, row in enumerate(r.m) if all(v == 0.0 for v in row)]
        assert 1 <= len(zero_rows) <= int(49 * 0.15)
        assert zero_rows == list(range(zero_rows[0], zero_rows[0] + len(zero_rows)))


def test_feature_mask_and_permutation(spark):
    g = _grid(spark)
    key = F.col("RecordID")
    r = g.select("x", feature_masking("x", key, 0.5, 2).alias("fm"), segment_permutation("x", key, 5, 3).alias("p")).collect()
    for row in r:
        cols = [j for j in range(6) if all(t[j] == 0.0 for t in row.fm)]
        assert 1 <= len(cols) <= 3
        assert row.p[45:] == row.x[45:]  # remainder stays last
        assert sorted(map(tuple, row.p)) == sorted(map(tuple, row.x))


def test_views_are_deterministic_and_loss_finite(spark):
    g = _grid(spark, n_ids=10)
    a = grid_views(g, seed=4).orderBy("RecordID", "view").collect()
    b = grid_views(g.repartition(3), seed=4).orderBy("RecordID", "view").collect()
    assert [r.x for r in a] == [r.x for r in b]
    z = grid_views(g, seed=4).select("RecordID", "view", mean_pool(F.col("x")).alias("z"))
    loss = info_nce(z, batch_size=4).toPandas()
    assert np.isfinite(loss["loss"]).all() and loss["n"].sum() == 10


def test_sinusoid(spark):
    r = spark.range(1).select(sinusoid(F.lit(3.0), 4).alias("e")).first().e
    exp = [np.sin(3.0), np.cos(3.0), np.sin(3.0 * np.exp(-2 * np.log(10000) / 4)), np.cos(3.0 * np.exp(-2 * np.log(10000) / 4))]
    assert np.allclose(r, exp)


def test_record_files(spark):
    d = tempfile.mkdtemp(prefix="wardline-rec-")
    for rid, rows in ((132539, [("00:00", "Age", 54), ("00:07", "HR", 80)]), (132540, [("00:00", "Age", 70)])):
        with open(os.path.join(d, f"{rid}.txt"), "w") as fh:
            fh.write("Time,Parameter,Value\n00:00,RecordID,%d\n" % rid)
            for t, p, v in rows:
                fh.write(f"{t},{p},{v}\n")
    with open(os.path.join(d, "notes.csv"), "w") as fh:
        fh.write("ignored\n")
    got = load_record_files(spark, d).collect()
    assert len(got) == 5
    assert {(r.RecordID, r.Parameter) for r in got} >= {(132539, "HR"), (132540, "Age"), (132540, "RecordID")}


def test_streaming_grid_ingestion(spark):
    from wardline.streaming import start_grid_ingestion
    src = tempfile.mkdtemp(prefix="wardline-src-")
    out = tempfile.mkdtemp(prefix="wardline-out-")
    ck = tempfile.mkdtemp(prefix="wardline-ck-")
    for rid in (1, 2):
        with open(os.path.join(src, f"{rid}.txt"), "w") as fh:
            fh.write(f"Time,Parameter,Value\n00:00,RecordID,{rid}\n00:10,HR,80\n01:30,HR,90\n")
    q = start_grid_ingestion(spark, src, os.path.join(out, "grid"), ck, available_now=True)
    q.awaitTermination(300)
    grid = spark.read.parquet(os.path.join(out, "grid"))
    assert grid.count() == 98
    assert grid.where("RecordID = 2 AND Time = 1").first().HR == 80.0
