"""Elapsed-time strings ``HH:MM`` (hours may exceed 23) and time bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm_to_minutes(c) -> Column:
    """``'HH:MM'`` -> minutes since admission (``'01:01'`` -> 61)."""
    parts = F.split(_c(c), ":")
    return (parts.getItem(0).cast("int") * 60 + parts.getItem(1).cast("int")).cast("int")


def elapsed_minutes(df: DataFrame, time_col: str) -> Column:
    """Minutes of ``time_col``, which holds ``'HH:MM'`` text or whole minutes."""
    if isinstance(df.schema[time_col].dataType, StringType):
        return hhmm_to_minutes(F.col(f"`{time_col}`"))
    return F.col(f"`{time_col}`").cast("int")


def minutes_to_bin(minutes, bin_minutes: int = 60) -> Column:
    """Ceiling bin: 0 -> 0, 1..60 -> 1, 61..120 -> 2 (hourly by default)."""
    return F.ceil(_c(minutes) / F.lit(float(bin_minutes))).cast("int")


def minutes_to_hhmm(minutes) -> Column:
    """Inverse of :func:`hhmm_to_minutes`; hours are zero padded, never cut."""
    m = _c(minutes).cast("long")
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("long"), F.pmod(m, F.lit(60)))


def run_name(model: str, day) -> str:
    """F16: ``model_YYYY-MM-DD``, the name of a training run started on ``day``."""
    return f"{model}_{day:%Y-%m-%d}"
