from pyspark.sql import functions as F

from long_records import long_df
from wardline.operators.scale import apply_minmax, apply_standard, fit_minmax, fit_standard
from wardline.operators.text import feature_phrase, rating_to_class, rating_to_probability, summaries
from wardline.operators.tuples import (
    apply_modality_map, fit_modality_map, pack_triplets, pad_sequences, split_triplets,
)


def test_minmax_and_standard(spark):
    train = spark.createDataFrame([(0.0, 3.0, 1.0), (10.0, 3.0, 3.0)], "a double, c double, s double")
    val = spark.createDataFrame([(15.0, 3.0, 1.0)], "a double, c double, s double")
    mm = fit_minmax(train, ["a", "c"])
    assert [r.a for r in apply_minmax(train, mm).collect()] == [0.0, 1.0]
    assert apply_minmax(val, mm).first().a == 1.5  # no clipping
    assert apply_minmax(train, mm).first().c == 0.0  # constant column -> 0
    st = fit_standard(train, ["s"])
    assert [r.s for r in apply_standard(train, st).collect()] == [-1.0, 1.0]  # population std


def test_modality_map_and_packing(spark):
    train = spark.createDataFrame([(1, 0, "Age", 50.0), (1, 0, "Gender", 1.0), (1, 5, "HR", 80.0),
                                   (2, 0, "Age", 60.0)], "RecordID long, Time int, Parameter string, Value double")
    mm = {r.Parameter: r.z for r in fit_modality_map(train).collect()}
    assert mm == {"Age": 1, "Gender": 2, "HR": 3, "<PAD>": 0}
    val = spark.createDataFrame([(3, 0, "Lactate", 1.0)], "RecordID long, Time int, Parameter string, Value double")
    assert apply_modality_map(val, fit_modality_map(train)).first().z is None
    seqs = spark.createDataFrame([(1, 0, "A", 1.0), (2, 0, "A", 1.0), (2, 1, "B", 2.0), (2, 2, "A", 3.0)],
                                 "RecordID long, Time int, Parameter string, Value double")
    seqs = seqs.withColumn("z", F.when(F.col("Parameter") == "A", 1).otherwise(2))
    packed = pad_sequences(split_triplets(pack_triplets(seqs, max_len=2)))
    got = {r.RecordID: r for r in packed.collect()}
    assert len(got[2].t) == 2 and got[2].v == [1.0, 2.0]  # truncated, earliest kept
    assert got[1].t == [0.0, -999.0] and got[1].z == [1, 0] and got[1].mask == [False, True]


def test_feature_text_and_summary(spark):
    desc = {"GCS": "[Glasgow Coma Score (3-15)]"}
    assert feature_phrase("GCS_mean", desc) == "mean GCS [Glasgow Coma Score (3-15)]"
    assert feature_phrase("Weight_VAR_mean", desc) == "Weight_VAR_mean"
    df = spark.createDataFrame([(1, 14.923, None, 80.0), (2, None, None, None)],
                               "RecordID long, GCS_mean double, BUN_min double, Weight_VAR_mean double")
    got = {r.RecordID: r.summary for r in summaries(df, ["GCS_mean", "BUN_min", "Weight_VAR_mean"], desc).collect()}
    assert got[1] == "mean GCS [Glasgow Coma Score (3-15)] 14.92. Weight_VAR_mean 80.0."
    assert got[2] == "."


def test_rating_to_probability(spark):
    df = spark.createDataFrame([(10,), (1,), (5,)], "Prediction int")
    got = [(r.p, r.c) for r in df.select(rating_to_probability().alias("p"), rating_to_class().alias("c")).collect()]
    assert got == [(0.0, 0), (0.9, 1), (0.5, 0)]
