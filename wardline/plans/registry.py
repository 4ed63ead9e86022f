"""Registry of named report queries: ``name -> (spark_fn, oracle_sql or None)``.

Every query takes ``(spark, sf_dir)``, reads the driver's tables and returns a
DataFrame.  Double columns are rounded to 6 digits at the very end (both in
Spark and in the SQL text), because float sums depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded_value(c, kind, digits: int):
    """``c`` of type ``kind`` with every double or float inside it rounded."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(c.cast("double"), digits) + F.lit(0.0)  # a negative zero becomes zero
    if "double" not in kind.simpleString() and "float" not in kind.simpleString():
        return c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: rounded_value(x, kind.elementType, digits))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[rounded_value(c[f.name], f.dataType, digits).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), inner)
    return c


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float, nested ones too (presentation step of a report)."""
    return df.select(*[rounded_value(F.col(f"`{f.name}`"), f.dataType, digits).alias(f.name) for f in df.schema.fields])


def r(expr: str, digits: int = DIGITS) -> str:
    """SQL rounding helper for the oracle text."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"
