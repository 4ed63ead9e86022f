"""Statistics Spark lacks in the exact form the reference uses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def adjusted_skew(c) -> Column:
    """Sample skewness with the bias adjustment ``sqrt(n(n-1))/(n-2) * g1``.

    Null below three values, 0 for a constant group (pandas ``skew``).
    Spark's ``skewness`` is the population ``g1`` and null on a constant.
    """
    col = _c(c)
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(col) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def adjusted_kurtosis(c) -> Column:
    """Excess kurtosis with the bias adjustment (pandas ``kurt``); null below four values."""
    col = _c(c)
    n = F.count(col).cast("double")
    g2 = F.kurtosis(col)  # population excess kurtosis
    adj = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.var_pop(col) == 0, F.lit(0.0))
            .otherwise(adj))
