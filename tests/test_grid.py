import pytest
from pyspark.sql import functions as F

from long_records import long_df
from wardline.functions.timefmt import hhmm_to_minutes, minutes_to_bin
from wardline.operators.grid import aggregate_duplicates, grid_minutes, time_grid
from wardline.operators.quality import apply_long_rules, apply_wide_rules
from wardline.sources.tables import events_as_records
from wardline.vocab import ICU


def test_duplicates(spark):
    rows = [(1, "HR", "01:00", 80.0), (1, "HR", "02:00", 80.0), (1, "HR", "02:00", 90.0),
            (1, "Temp", "01:00", 0.5), (1, "Temp", "01:00", 37.0),
            (1, "Urine", "01:00", 30.0), (1, "Urine", "01:00", 40.0),
            (1, "Urine", "02:00", 10.0), (1, "Urine", "02:00", 20.0), (1, "Urine", "02:00", 30.0),
            (1, "HCT", "01:00", 30.0), (1, "HCT", "01:00", 31.0), (1, "HCT", "01:00", 35.0),
            (1, "Na", "01:00", 130.0), (1, "Na", "01:00", 140.0), (1, "Na", "01:00", 150.0)]
    got = {(r.Parameter, r.Time): r.Value for r in
           aggregate_duplicates(long_df(spark, rows), ICU, strict=False).collect()}
    assert got[("HR", "01:00")] == 80 and got[("HR", "02:00")] == 85
    assert got[("Temp", "01:00")] == 37 and got[("Urine", "01:00")] == 70
    assert got[("Urine", "02:00")] == 60 and got[("HCT", "01:00")] == 32
    assert got[("Na", "01:00")] == 140
    with pytest.raises(Exception):
        aggregate_duplicates(long_df(spark, rows), ICU, strict=True).collect()


def test_all_null_sum_is_zero(spark):
    rows = [(1, "Urine", "01:00", None), (1, "Urine", "01:00", None)]
    assert aggregate_duplicates(long_df(spark, rows), ICU).first().Value == 0.0


def test_time_parsing(spark):
    df = spark.createDataFrame([("00:00",), ("00:01",), ("01:00",), ("01:01",), ("48:00",), ("100:05",)], "t string")
    got = df.select(hhmm_to_minutes("t").alias("m"), minutes_to_bin(hhmm_to_minutes("t")).alias("h")).collect()
    assert [(r.m, r.h) for r in got] == [(0, 0), (1, 1), (60, 1), (61, 2), (2880, 48), (6005, 101)]


def test_grid_urine_zero_and_density(spark):
    rows = [(1, "HR", "00:10", 80.0), (1, "HR", "00:50", 100.0)]
    g = time_grid(long_df(spark, rows), ICU).orderBy("Time").collect()
    assert len(g) == 49
    assert g[1].HR == 90 and g[1].Urine == 0.0
    assert all(r.HR is None and r.Urine is None for i, r in enumerate(g) if i != 1)
    assert all(r.Gender == 1.0 for r in g)  # missing gender -> 1


def test_static_chosen_before_rules(spark):
    rows = [(1, "Weight", "00:00", -1.0), (1, "Weight", "05:00", 70.0)]
    g = {r.Time: r for r in time_grid(long_df(spark, rows), ICU).collect()}
    assert all(r.Weight is None for r in g.values())
    assert g[5].Weight_VAR == 70 and g[0].Weight_VAR is None


def test_wide_rules(spark):
    cols = ICU.grid_vars
    base = {c: None for c in cols}
    cases = [("Gender", -1.0, 1.0), ("Height", 99.0, None), ("Height", 100.0, 100.0), ("Height", 251.0, None),
             ("Weight", 19.9, None), ("Weight", 400.0, 400.0), ("HR", 9.0, None), ("HR", 10.0, 10.0),
             ("MAP", 0.0, None), ("pH", 5.9, None), ("pH", 8.0, 8.0), ("Temp", 46.0, None),
             ("Temp", 12.0, 12.0), ("Platelets", 0.0, 0.0)]
    for var, val, exp in cases:
        row = dict(base, **{var: val})
        df = spark.createDataFrame([tuple(row[c] for c in cols)], ", ".join(f"`{c}` double" for c in cols))
        assert apply_wide_rules(df, ICU).first()[var] == exp, (var, val)


def test_long_rules(spark):
    rows = [(1, "Gender", "00:00", -1.0), (1, "RecordID", "00:00", 1.0), (1, "ICUType", "00:00", 2.0),
            (1, "HR", "00:00", 9.0), (1, "Temp", "00:00", 37.0)]
    got = {r.Parameter: r.Value for r in apply_long_rules(long_df(spark, rows), ICU).collect()}
    assert got == {"Gender": 1.0, "RecordID": None, "ICUType": None, "HR": None, "Temp": 37.0}


def test_grid_of_minutes_equals_grid_of_text(spark):
    rows = [(1, "HR", "00:10", 80.0), (1, "HR", "48:00", 100.0), (1, "HR", "48:01", 1.0), (1, "Urine", "03:00", 5.0),
            (1, "Urine", "03:00", 6.0), (2, "HR", "05:30", 60.0), (3, "HR", None, 60.0)]
    text = long_df(spark, rows)
    minutes = text.withColumn("Time", hhmm_to_minutes("Time"))
    a = sorted(map(tuple, time_grid(text, ICU).collect()), key=str)
    assert a == sorted(map(tuple, time_grid(minutes, ICU).collect()), key=str)
    assert {r[0] for r in a} == {1, 2} and len(a) == 2 * 49


def test_first_and_last_minute_of_the_grid(spark):
    df = spark.range(-200, 3100).select(F.col("id").alias("m"), minutes_to_bin("m").alias("b"))
    for bins in (1, 49):
        inside = [r.m for r in df.where(F.col("b").between(0, bins - 1)).collect()]
        assert (min(inside), max(inside)) == grid_minutes(60, bins)


def test_range_of_time_stamps_reaches_the_scan(spark, tmp_path):
    rows = spark.sql("""SELECT explode(sequence(-90, 90)) m""").selectExpr(
        "timestampadd(SECOND, 60 * m + 59, TIMESTAMP_NTZ'2024-01-01 00:00:00') ts", "1L user_id",
        "'view' event_type", "CAST(m AS DOUBLE) value")
    for kind in ("timestamp", "timestamp_ntz"):
        path = str(tmp_path / kind)
        rows.withColumn("ts", F.col("ts").cast(kind)).write.parquet(path)
        got = events_as_records(spark.read.parquet(path), "2024-01-01 00:00:00", (-59, 60))
        assert sorted((r.Time, r.Value) for r in got.collect()) == [(m, float(m)) for m in range(-59, 61)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
