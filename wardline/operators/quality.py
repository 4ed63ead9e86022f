"""Quality rules and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.vocab import Vocabulary


def _violates(c: Column, kind: str, bound: float) -> Column:
    if kind == "below":
        return c < F.lit(bound)
    if kind == "above":
        return c > F.lit(bound)
    if kind == "at_most":
        return c <= F.lit(bound)
    raise ValueError(f"unknown rule kind {kind}")


def rule_predicates(rules) -> dict[str, Column]:
    """Group rules by variable: {var: OR of its violation predicates}."""
    out: dict[str, Column] = {}
    for var, kind, bound in rules:
        p = _violates(F.col(f"`{var}`"), kind, bound)
        out[var] = p if var not in out else (out[var] | p)
    return out


def apply_wide_rules(df: DataFrame, vocab: Vocabulary) -> DataFrame:
    """P5 + P6: implausible values -> null; default-filled statics (Gender)
    replace a negative or missing value.  One ``select``, no column loop."""
    preds = rule_predicates(vocab.grid_rules)
    cols = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in vocab.default_fill:
            c = F.when(c.isNull() | (c < 0), F.lit(float(vocab.default_fill[name]))).otherwise(c)
        if name in preds:
            c = F.when(preds[name], F.lit(None).cast("double")).otherwise(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def apply_long_rules(df: DataFrame, vocab: Vocabulary, param_col: str = "Parameter",
                     value_col: str = "Value") -> DataFrame:
    """The same bounds on the long table, one chained ``when`` on the parameter.

    Defaults replace negatives only (a missing long row does not exist);
    identifier and category parameters become null.
    """
    p, v = F.col(param_col), F.col(value_col)
    expr = None

    def add(cond, val):
        nonlocal expr
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)

    for var, dflt in vocab.default_fill.items():
        add((p == var) & (v < 0), F.lit(float(dflt)))
    for var in vocab.tuple_null_params:
        add(p == var, F.lit(None).cast("double"))
    for var, kind, bound in vocab.tuple_rules:
        add((p == var) & _violates(v, kind, bound), F.lit(None).cast("double"))
    if expr is None:
        return df
    return df.withColumn(value_col, expr.otherwise(v))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """``(column, n_null)`` for every column, from a single pass.

    NaN counts as missing too.
    """
    columns = columns or df.columns
    aggs = []
    for c in columns:
        col = F.col(f"`{c}`")
        dtype = dict(df.dtypes)[c]
        miss = col.isNull() | F.isnan(col) if dtype in ("double", "float") else col.isNull()
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, n_null)")


def assert_no_nulls(df: DataFrame, columns=None) -> None:
    """Raise when any column still holds a null (one job)."""
    bad = null_counts(df, columns).where("n_null > 0").collect()
    if bad:
        raise ValueError(f"columns with nulls: {[(r['column'], r['n_null']) for r in bad]}")


def columns_with_nulls(df: DataFrame, columns=None) -> list[str]:
    return [r["column"] for r in null_counts(df, columns).where("n_null > 0").collect()]


def drop_null_columns(df: DataFrame, keep=()) -> DataFrame:
    """Drop every column that holds a null (one counting pass, one small decision)."""
    bad = set(columns_with_nulls(df)) - set(keep)
    return df.select(*[f"`{c}`" for c in df.columns if c not in bad])


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    """Bad strings -> null (``try_cast``), never an error under ANSI mode."""
    cols = [F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) if c in columns else F.col(f"`{c}`")
            for c in df.columns]
    return df.select(*cols)


def assert_same_keys(left: DataFrame, right: DataFrame, key: str = "RecordID") -> None:
    """Both tables hold exactly the same key set (one full outer join of
    the distinct keys; only the count of one-sided keys reaches the driver)."""
    lk = left.select(F.col(key).alias("_k")).distinct().withColumn("_l", F.lit(1))
    rk = right.select(F.col(key).alias("_k")).distinct().withColumn("_r", F.lit(1))
    row = (lk.join(rk, "_k", "full_outer")
           .agg(F.count_if(F.col("_l").isNull()).alias("only_right"),
                F.count_if(F.col("_r").isNull()).alias("only_left"))
           .first())
    if row["only_left"] or row["only_right"]:
        raise ValueError(f"key sets differ: {row['only_left']} only left, {row['only_right']} only right")
