import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.functions.randomness import hash_normal, hash_uniform
from wardline.functions.timefmt import run_name
from wardline.operators.augment import info_nce
from wardline.operators.features import fill_features
from wardline.operators.joins import splits_of
from wardline.operators.ml import add_folds, feature_importances, logistic_regression, random_forest, vectors
from wardline.operators.quality import assert_no_nulls, coerce_numeric, drop_null_columns
from wardline.operators.sample import n_per_class
from wardline.operators.scale import apply_param_minmax, fit_param_minmax
from wardline.operators.text import batch_inference
from wardline.operators.tuples import apply_modality_map, fit_modality_map, vocabulary_size
from wardline.sources.records import load_record_files, top_ranked


def test_every_id_is_in_one_split(spark):
    parts = splits_of(spark.range(-5, 95).withColumnRenamed("id", "RecordID"))
    sizes = {k: v.count() for k, v in parts.items()}
    assert sizes == {"a": 70, "b": 10, "c": 20}


def test_fit_of_one_split_applied_to_another(spark):
    train = spark.createDataFrame([(1, 2.0, None), (2, 4.0, None), (3, None, None)], "RecordID long, x double, y double")
    other = spark.createDataFrame([(9, None, 7.0)], "RecordID long, x double, y double")
    t, others, med = fill_features(train, {"c": other})
    assert t.columns == ["RecordID", "x"] and others["c"].collect() == [(9, 3.0)] and med["y"] is None


def test_unseen_parameter_and_value_out_of_range(spark):
    schema = "RecordID long, Parameter string, Time int, Value double"
    train = spark.createDataFrame([(1, "HR", 0, 10.0), (1, "HR", 5, 20.0)], schema)
    new = spark.createDataFrame([(2, "HR", 10, 40.0), (2, "pH", 10, 7.0)], schema)
    rows = {r.Parameter: r for r in apply_param_minmax(new, fit_param_minmax(train), time_range=10).collect()}
    assert rows["HR"].Value == 3.0 and rows["pH"].Value is None and rows["pH"].Time == 1.0
    z = {r.Parameter: r.z for r in apply_modality_map(new, fit_modality_map(train)).collect()}
    assert z == {"HR": 1, "pH": None}


def test_vocabulary_is_checked_against_the_configuration(spark):
    m = spark.createDataFrame([("<PAD>", 0), ("HR", 1), ("pH", 2)], "Parameter string, z int")
    assert vocabulary_size(m) == 3 == vocabulary_size(m, configured=3)
    with pytest.raises(ValueError):
        vocabulary_size(m, configured=2)


def test_folds_are_balanced_by_class(spark):
    df = spark.range(103).select(F.col("id").alias("RecordID"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    n = {(r.label, r.fold): r["count"] for r in add_folds(df, 5).groupBy("label", "fold").count().collect()}
    for label in (0, 1):
        sizes = [n.get((label, k), 0) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == (92, 11)[label]


def test_n_per_class_takes_all_of_a_small_class(spark):
    df = spark.range(50).select(F.col("id").alias("RecordID"), (F.col("id") < 3).cast("int").alias("label"))
    n = {r.label: r["count"] for r in n_per_class(df, 5, seed=2).groupBy("label").count().collect()}
    assert n == {0: 5, 1: 3}
    assert n_per_class(df, 5, 2).orderBy("RecordID").collect() == n_per_class(df.repartition(7), 5, 2).orderBy("RecordID").collect()


def test_draws_have_the_named_distributions(spark):
    r = spark.range(20000).select(hash_uniform(1, "id").alias("u"), hash_normal(1, "id").alias("z")).toPandas()
    assert abs(r.u.mean() - 0.5) < 0.01 and abs(r.u.var() - 1 / 12) < 0.005 and r.u.between(0, 1, "left").all()
    assert abs(r.z.mean()) < 0.03 and abs(r.z.std() - 1) < 0.02 and abs((r.z.abs() < 1.96).mean() - 0.95) < 0.01


def test_contrastive_loss_against_numpy(spark):
    rng = np.random.default_rng(3)
    z = rng.normal(size=(2, 7, 4))
    df = spark.createDataFrame([(i, v + 1, z[v, i].tolist()) for v in (0, 1) for i in range(7)],
                               "RecordID long, view int, z array<double>")
    row = info_nce(df, batch_size=10).first()
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in z)
    s = a @ b.T / 0.2
    ce = [np.mean(np.log(np.exp(m).sum(axis=1)) - np.diag(m)) for m in (s, s.T)]
    assert row.n == 7 and np.isclose(row.loss, np.mean(ce))
    assert sorted(r.n for r in info_nce(df, batch_size=3).collect()) == [1, 3, 3]


def test_column_rules(spark):
    df = spark.createDataFrame([("1.5", 1, None), ("x", 2, 3)], "a string, b int, c int")
    assert [r.a for r in coerce_numeric(df, ["a"]).collect()] == [1.5, None]
    assert drop_null_columns(df).columns == ["a", "b"]
    assert_no_nulls(df, ["a", "b"])
    with pytest.raises(ValueError):
        assert_no_nulls(df)


def test_small_helpers(spark):
    ranked = spark.createDataFrame([(1, "HR"), (2, "pH"), (3, "WBC")], "rank int, feature string")
    assert {r.feature for r in top_ranked(ranked, 2).collect()} == {"HR", "pH"}
    assert run_name("lstm", datetime.date(2025, 3, 9)) == "lstm_2025-03-09"
    out = batch_inference(spark.range(5), lambda p: p.assign(y=p["id"] * 2.0), "id long, y double")
    assert sorted(map(tuple, out.collect())) == [(i, 2.0 * i) for i in range(5)]


def test_models(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = (x[:, 1] > 0).astype(int)
    df = vectors(spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(200)],
                                       "RecordID long, x array<double>, label int"), "x")
    ranked = feature_importances(random_forest(20, 4, seed=1).fit(df), ["f0", "f1", "f2"]).collect()
    assert ranked[0].feature == "f1" and np.isclose(sum(r.importance for r in ranked), 1)
    strong, weak = (np.linalg.norm(logistic_regression(c, 200.0).fit(df).coefficients.toArray()) for c in (0.01, 10.0))
    assert strong < weak


def test_record_file_without_an_id_is_named(spark, tmp_path):
    (tmp_path / "good.txt").write_text("Time,Parameter,Value\n00:00,RecordID,7\n00:05,HR,80\n")
    assert sorted(r.RecordID for r in load_record_files(spark, str(tmp_path)).collect()) == [7, 7]
    (tmp_path / "bad.txt").write_text("Time,Parameter,Value\n00:00,Age,54\n")
    with pytest.raises(Exception, match="bad.txt"):
        load_record_files(spark, str(tmp_path)).collect()
