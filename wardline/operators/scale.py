"""Scalers fitted on training data.

Wide scalers fit one row of numbers (two per column) that is applied as
literals.  The per-parameter scaler is one row per parameter; it is broadcast
when the parameter count is below a checked bound and joined otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.common import broadcast_if_bounded
from wardline.vocab import ICU_TIME_SCALE_MINUTES

BROADCAST_MAX_PARAMS = 100_000


def _q(c):
    return F.col(f"`{c}`")


def fit_minmax(train: DataFrame, columns) -> dict:
    """``{column: (min, max)}`` from one aggregate."""
    row = train.agg(*[F.min(_q(c)).alias(f"mn_{c}") for c in columns],
                    *[F.max(_q(c)).alias(f"mx_{c}") for c in columns]).first()
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in columns}


def minmax_expr(c, mn, mx):
    """``(x - min) / range``; a constant column has range 1 (so 0 on
    train); no clipping of values outside the training range."""
    if mn is None:
        return c
    rng = (mx - mn) if (mx is not None and mx != mn) else 1.0
    return (c - F.lit(float(mn))) / F.lit(float(rng))


def apply_minmax(df: DataFrame, fitted: dict) -> DataFrame:
    return df.select(*[minmax_expr(_q(c), *fitted[c]).alias(c) if c in fitted else _q(c)
                       for c in df.columns])


def fit_standard(train: DataFrame, columns) -> dict:
    """A23 (standard): ``{column: (mean, population std)}``."""
    row = train.agg(*[F.avg(_q(c)).alias(f"m_{c}") for c in columns],
                    *[F.stddev_pop(_q(c)).alias(f"s_{c}") for c in columns]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standard_expr(c, mean, std):
    """``(x - mean) / std`` with population std; std 0 -> divide by 1."""
    if mean is None:
        return c
    s = std if (std is not None and std > 0) else 1.0
    return (c - F.lit(float(mean))) / F.lit(float(s))


def apply_standard(df: DataFrame, fitted: dict) -> DataFrame:
    return df.select(*[standard_expr(_q(c), *fitted[c]).alias(c) if c in fitted else _q(c)
                       for c in df.columns])


def fit_param_minmax(train_long: DataFrame, param_col: str = "Parameter",
                     value_col: str = "Value") -> DataFrame:
    """Per parameter min and max of the training values (map-side
    partial aggregation; one row per parameter)."""
    return train_long.groupBy(param_col).agg(F.min(value_col).alias("_mn"), F.max(value_col).alias("_mx"))


def apply_param_minmax(df: DataFrame, fitted: DataFrame, param_col: str = "Parameter",
                       value_col: str = "Value", time_col: str = "Time",
                       time_range: float = ICU_TIME_SCALE_MINUTES) -> DataFrame:
    """F4 + J8: value scaled with its parameter's training min/max (parameters
    unseen in training get a null value), time divided by the fixed range."""
    # the fit runs once; its rows come back as a broadcast table when few
    side = broadcast_if_bounded(fitted, BROADCAST_MAX_PARAMS)
    rng = F.when(F.col("_mx") > F.col("_mn"), F.col("_mx") - F.col("_mn")).otherwise(F.lit(1.0))
    return (df.join(side, param_col, "left")
            .withColumn(value_col, (F.col(value_col) - F.col("_mn")) / rng)
            .withColumn(time_col, F.col(time_col).cast("double") / F.lit(float(time_range)))
            .drop("_mn", "_mx"))
