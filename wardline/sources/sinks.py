"""Sinks (S6-S9).  One table partitioned by ``split`` replaces one file per split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_split_table(df: DataFrame, path: str, split_col: str | None = "split",
                      mode: str = "overwrite") -> None:
    """Parquet (array columns included), partitioned by split if present."""
    w = df.write.mode(mode)
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, no index column.  Array columns are joined by ','."""
    out = df
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            out = out.withColumn(f.name, F.array_join(F.col(f.name).cast("array<string>"), ","))
    out.write.mode(mode).option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """A small metrics table (loss, accuracy, auROC, auPRC, confusion matrix)."""
    out = metrics.coalesce(1)
    if fmt == "json":
        out.write.mode(mode).json(path)
    else:
        write_csv(out, path, mode)
