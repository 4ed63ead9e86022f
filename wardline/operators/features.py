"""Per-entity feature vectors from the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.stats import adjusted_skew
from wardline.operators.impute import fill_values, fit_medians, unfillable_columns

STATS = ("mean", "std", "max", "min", "skew")


def _q(c):
    return F.col(f"`{c}`")


def _stat(name: str, c):
    if name == "mean":
        return F.avg(c)
    if name == "std":
        return F.stddev_samp(c)
    if name == "max":
        return F.max(c)
    if name == "min":
        return F.min(c)
    if name == "skew":
        return adjusted_skew(c)
    raise ValueError(name)


def mean_features(grid: DataFrame, series_vars, static_vars, id_col: str = "RecordID") -> DataFrame:
    """Per entity the mean of each series and the first non-null static.

    Names carry no suffix (``HR``, ``Age``).  Grouping by id reuses the
    grid's id partitioning.
    """
    aggs = [F.avg(_q(v)).alias(v) for v in series_vars]
    aggs += [F.first(_q(s), ignorenulls=True).alias(s) for s in static_vars]
    return grid.groupBy(id_col).agg(*aggs)


def stat_features(grid: DataFrame, series_vars, static_vars, id_col: str = "RecordID",
                  stats=STATS) -> DataFrame:
    """Per entity ``{var}_{stat}`` for mean, sample std, max, min and
    adjusted skew, plus ``{static}_first``.  One aggregate, one pass."""
    aggs = [_stat(s, _q(v)).alias(f"{v}_{s}") for v in series_vars for s in stats]
    aggs += [F.first(_q(s), ignorenulls=True).alias(f"{s}_first") for s in static_vars]
    return grid.groupBy(id_col).agg(*aggs)


def fill_features(train: DataFrame, others: dict, id_col: str = "RecordID"):
    """A9 + P15: fit medians on ``train``; drop columns that cannot be filled;
    fill train and every other split with the train medians.

    Returns ``(train_filled, {name: filled}, medians)``.
    """
    cols = [c for c in train.columns if c != id_col]
    med = fit_medians(train, cols)
    drop = unfillable_columns(med)
    t = fill_values(train.drop(*drop), med)
    return t, {k: fill_values(v.drop(*drop), med) for k, v in others.items()}, med


def grouped_mean(df: DataFrame, by, columns) -> DataFrame:
    """Mean of every column per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.avg(_q(c)).alias(c) for c in columns])


def grouped_variance(df: DataFrame, by, columns) -> DataFrame:
    """Sample variance (ddof 1) per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.var_samp(_q(c)).alias(c) for c in columns])
