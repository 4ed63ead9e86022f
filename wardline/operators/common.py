"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a single-row result (a global aggregate) to every
    row of ``df``: an equi-join on a constant key with the one row broadcast."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one")
            .drop("_one"))


def broadcast_if_bounded(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Broadcast a small side only after checking its size.

    At most ``limit + 1`` rows are fetched; within the limit the rows are
    shipped back as a local table and broadcast (the side is computed once),
    beyond it the side is returned as is and Spark plans a shuffle join.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return df
