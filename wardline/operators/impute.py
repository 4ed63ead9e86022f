"""Imputation.

Fitted quantities (medians, means) come from the training split only and are
a handful of numbers, one per column; they are applied as literals, so
applying them needs neither a join nor a re-run of the fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.operators.quantiles import exact_medians


def forward_fill(df: DataFrame, columns, id_col: str = "RecordID", time_col: str = "Time") -> DataFrame:
    """Last non-null value so far within each id, in time order.

    All columns share one window (one sort per id group; groups are one
    grid per entity, so bounded).
    """
    w = (Window.partitionBy(id_col).orderBy(time_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cols = set(columns)
    return df.select(*[F.last(F.col(f"`{c}`"), ignorenulls=True).over(w).alias(c) if c in cols
                       else F.col(f"`{c}`") for c in df.columns])


def fit_medians(train: DataFrame, columns) -> dict:
    """Exact column medians (nulls skipped); None when a column is all null."""
    return exact_medians(train, columns)


def fit_means(train: DataFrame, columns) -> dict:
    """A10: column means in one aggregate."""
    row = train.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """W2 / A9 apply: remaining nulls -> fitted value (columns with a None value are left)."""
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(float(values[c]))).alias(c)
                       if values.get(c) is not None else F.col(f"`{c}`") for c in df.columns])


def unfillable_columns(values: dict) -> list[str]:
    """Columns whose fitted value is null (all-null in train) cannot be filled."""
    return [c for c, v in values.items() if v is None]


def ffill_and_fill(df: DataFrame, train: DataFrame, columns, id_col: str = "RecordID",
                   time_col: str = "Time", how: str = "median") -> DataFrame:
    """W1 + W2: forward fill per id, then the train median (or mean) of each column.

    The fit reads the un-filled training grid (all rows), as the reference does.
    """
    values = fit_medians(train, columns) if how == "median" else fit_means(train, columns)
    return fill_values(forward_fill(df, columns, id_col, time_col), values)
