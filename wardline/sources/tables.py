"""Parquet scans and adapters from the driver's tables.

The adapters only rename and reshape columns into the schema an operator
expects; they do none of the operator's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import table_path
from wardline.vocab import EVENTS_ORIGIN


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None,
               drop=None) -> DataFrame:
    """Parquet scan; selecting columns lets Catalyst prune the read schema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    if drop:
        df = df.drop(*drop)
    return df


def events_as_records(events: DataFrame, origin: str = EVENTS_ORIGIN,
                      minutes_between: tuple[int, int] | None = None) -> DataFrame:
    """``events`` as a long record table ``(RecordID, Parameter, Time INT minutes, Value)``.

    Time is the elapsed time since ``origin`` in whole minutes.  With
    ``minutes_between`` (both included) the time stamps outside that range are
    left out by a comparison of the bare ``ts`` column, which reaches the scan.
    """
    if minutes_between is not None:
        lo, hi = minutes_between
        start = F.lit(origin).cast(events.schema["ts"].dataType)
        events = events.where((F.col("ts") >= start + F.make_dt_interval(mins=F.lit(lo)))
                              & (F.col("ts") < start + F.make_dt_interval(mins=F.lit(hi + 1))))
    # whole minutes on the wall clock (time-zone independent)
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{origin}', CAST(ts AS TIMESTAMP_NTZ))")
    minutes = F.floor(micros / F.lit(60_000_000.0))
    return events.select(
        F.col("user_id").cast("long").alias("RecordID"),
        F.col("event_type").alias("Parameter"),
        minutes.cast("int").alias("Time"),
        F.when(F.isnan("value"), None).otherwise(F.col("value")).alias("Value"),
    )


def events_outcomes(events: DataFrame, threshold: float = 200.0) -> DataFrame:
    """Stand-in binary outcome per user: 1 when any ``error`` event exceeds
    ``threshold``.  Used where the reference joins an outcomes file."""
    return (events.groupBy(F.col("user_id").cast("long").alias("RecordID"))
            .agg(F.max(F.when((F.col("event_type") == "error") & (F.col("value") > threshold), 1)
                       .otherwise(0)).alias("label")))


def labels_as_outcomes(labels: DataFrame, label_src: str = "quality") -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("RecordID"),
                         F.col(label_src).cast("int").alias("label"))


def embeddings_as_vectors(embeddings: DataFrame) -> DataFrame:
    """``embeddings`` as ``(RecordID, embedding ARRAY<FLOAT>, label)`` with the
    ten classes folded to a binary outcome (class below 5 -> 1)."""
    return embeddings.select(F.col("vec_id").cast("long").alias("RecordID"),
                             F.col("embedding"),
                             (F.col("label") < 5).cast("int").alias("label"))


def wide_to_vector(df: DataFrame, id_col: str, value_cols: list[str],
                   out_col: str = "embedding") -> DataFrame:
    """Wide numbered columns ``1..d`` -> one ``ARRAY<FLOAT>`` column."""
    return df.select(F.col(id_col),
                     F.array(*[F.col(f"`{c}`").cast("float") for c in value_cols]).alias(out_col))
