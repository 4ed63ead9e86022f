import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wardline.operators.joins import concat_splits, join_feature_sets, keep_members, label_lookup, with_outcomes
from wardline.operators.metrics import best_epoch
from wardline.operators.text import clean_response, response_score, score_predictions
from wardline.sources.records import read_dictionary, read_outcomes, read_ranked_features
from wardline.sources.sinks import write_csv, write_metrics, write_split_table


def test_small_file_sources(spark):
    d = tempfile.mkdtemp(prefix="wardline-io-")
    with open(os.path.join(d, "outcomes.txt"), "w") as fh:
        fh.write("RecordID,SAPS-I,In-hospital_death\n1,10,0\n2,12,1\n")
    with open(os.path.join(d, "vars.csv"), "w") as fh:
        fh.write("variable,description\nGCS,[Glasgow Coma Score (3-15)]\n")
    with open(os.path.join(d, "ranked.txt"), "w") as fh:
        fh.write("1. 0.31 GCS_mean\n2. 0.20   BUN_min\n\n3. 0.1 Age_first\n")
    assert {(r.RecordID, r.label) for r in read_outcomes(spark, os.path.join(d, "outcomes.txt")).collect()} == {(1, 0), (2, 1)}
    assert read_dictionary(spark, os.path.join(d, "vars.csv")).first().description == "[Glasgow Coma Score (3-15)]"
    ranked = [(r["rank"], r.feature) for r in read_ranked_features(spark, os.path.join(d, "ranked.txt")).collect()]
    assert ranked == [(1, "GCS_mean"), (2, "BUN_min"), (3, "Age_first")]


def test_sinks_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="wardline-sink-")
    df = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "b", [3.0])], "RecordID long, split string, x array<double>")
    write_split_table(df, os.path.join(d, "t"))
    back = spark.read.parquet(os.path.join(d, "t"))
    assert back.where("split = 'b'").first().x == [3.0]
    write_csv(df, os.path.join(d, "c"))
    assert spark.read.option("header", True).csv(os.path.join(d, "c")).where("RecordID = '1'").first().x == "1.0,2.0"
    m = spark.createDataFrame([(0.9, 0.77, [[10, 2], [3, 4]])], "loss double, accuracy double, cm array<array<long>>")
    write_metrics(m, os.path.join(d, "m"))
    assert spark.read.json(os.path.join(d, "m")).first().cm == [[10, 2], [3, 4]]


def test_joins(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "RecordID long, f double")
    y = spark.createDataFrame([(1, 0), (3, 1)], "RecordID long, label int")
    assert {r.RecordID: r.label for r in with_outcomes(a, y).collect()} == {1: 0, 2: None}
    assert [r.RecordID for r in keep_members(a, y).collect()] == [1]
    with pytest.raises(ValueError):
        label_lookup(a, y)
    b = spark.createDataFrame([(3, 5.0)], "RecordID long, g double")
    assert join_feature_sets([a, b]).count() == 3
    assert concat_splits({"a": a, "b": b}).where("split = 'b'").count() == 1


def test_response_parsing_and_scoring(spark):
    df = spark.createDataFrame([(["  7", "\n"],), (["I think 10"],), (["none"],)], "chunks array<string>")
    cleaned = df.select(clean_response("chunks").alias("text"))
    got = [(r.text, r.s) for r in cleaned.select("text", response_score("text").alias("s")).collect()]
    assert got == [("7", 7), ("I think 10", 10), ("none", None)]
    preds = spark.createDataFrame([(1, 10), (2, 1)], "RecordID long, Prediction int")
    out = spark.createDataFrame([(1, 0), (2, 1)], "RecordID long, label int")
    s = {r.RecordID: (r.probability, r.pred) for r in score_predictions(preds, out).collect()}
    assert s == {1: (0.0, 0), 2: (0.9, 1)}


def test_best_epoch(spark):
    h = spark.createDataFrame([(1, 0.6), (2, 0.7), (3, 0.69), (4, 0.7), (5, 0.65), (6, 0.64)], "epoch int, auroc double")
    r = best_epoch(h, "auroc", patience=2).first()
    assert r.best_epoch == 2 and r.best_auroc == 0.7 and r.stop_epoch == 6
