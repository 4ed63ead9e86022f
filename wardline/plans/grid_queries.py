"""E1 and E3 front half on the ``events`` table: records -> grid -> features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.features import fill_features, mean_features, stat_features, STATS
from wardline.functions.timefmt import minutes_to_hhmm
from wardline.operators.grid import aggregate_duplicates, grid_minutes, pivot_records, time_grid
from wardline.operators.impute import ffill_and_fill
from wardline.plans.registry import register, rounded, r
from wardline.session import cut_lineage
from wardline.sources.tables import events_as_records, read_table
from wardline.vocab import EVENTS, EVENTS_BIN_MINUTES, EVENTS_N_BINS, EVENTS_ORIGIN

V = EVENTS


def events_records(spark: SparkSession, sf_dir: str, minutes_between=None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", columns=["ts", "user_id", "event_type", "value"])
    return events_as_records(ev, minutes_between=minutes_between)


def deduplicated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_duplicates(events_records(spark, sf_dir), V, strict=False)


def events_grid_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = events_records(spark, sf_dir, grid_minutes(EVENTS_BIN_MINUTES, EVENTS_N_BINS))
    return time_grid(inside, V, bin_minutes=EVENTS_BIN_MINUTES, n_bins=EVENTS_N_BINS)


def events_grid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid, materialised once (reliable checkpoint) for queries that fit
    on it and then apply the fit: the fit's jobs and the final job read the
    stored grid instead of recomputing it from the events."""
    return cut_lineage(events_grid_df(spark, sf_dir))


# ---------------------------------------------------------------- SQL text
_MINUTE = (f"CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '{EVENTS_ORIGIN}')) / 60000000.0) AS BIGINT)")
_HHMM = ("(CASE WHEN m // 60 < 10 THEN '0' ELSE '' END) || CAST(m // 60 AS VARCHAR) || ':' || "
         "(CASE WHEN m % 60 < 10 THEN '0' ELSE '' END) || CAST(m % 60 AS VARCHAR)")


def _sql_dedup_value(param="Parameter", value="Value") -> str:
    s = ", ".join(f"'{p}'" for p in V.sum_params)
    mx = ", ".join(f"'{p}'" for p in V.max_params)
    two = (f"CASE WHEN {param} IN ({s}) THEN coalesce(sum({value}), 0) "
           f"WHEN {param} IN ({mx}) THEN max({value}) ELSE avg({value}) END")
    return f"CASE WHEN count(*) = 1 THEN avg({value}) ELSE {two} END"


SQL_RECORDS = f"""
  rec AS (
    SELECT user_id AS RecordID, event_type AS Parameter, {_MINUTE} AS m,
           CASE WHEN isnan(value) THEN NULL ELSE value END AS Value
    FROM events),
  dedup AS (
    SELECT RecordID, Parameter, m, {_sql_dedup_value()} AS Value
    FROM rec WHERE RecordID IS NOT NULL AND Parameter IS NOT NULL
    GROUP BY RecordID, Parameter, m)"""


def _rule_sql(var: str, rules) -> str:
    conds = []
    for v, kind, bound in rules:
        if v != var:
            continue
        op = {"below": "<", "above": ">", "at_most": "<="}[kind]
        conds.append(f'"{var}" {op} {bound}')
    if not conds:
        return f'"{var}"'
    return f'CASE WHEN {" OR ".join(conds)} THEN NULL ELSE "{var}" END'


def _sparse_aggs() -> str:
    out = []
    for v in V.raw_params:
        val = f"CASE WHEN Parameter = '{v}' THEN Value END"
        out.append(f"coalesce(sum({val}), 0) AS \"{v}\"" if v in V.hourly_sum_params
                   else f"avg({val}) AS \"{v}\"")
    return ",\n           ".join(out)


def _grid_cols() -> str:
    out = []
    for v in V.grid_vars:
        if v in V.static_vars:
            out.append(f'first("{v}" IGNORE NULLS) OVER (PARTITION BY RecordID ORDER BY Time '
                       f'ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS "{v}"')
        elif v in V.static_copies.values():
            src = [s for s, d in V.static_copies.items() if d == v][0]
            out.append(f'"{src}" AS "{v}"')
        else:
            out.append(f'"{v}"')
    return ", ".join(out)


SQL_GRID_CTE = SQL_RECORDS + f""",
  sparse AS (
    SELECT RecordID, CAST(ceil(m / {float(EVENTS_BIN_MINUTES)}) AS INTEGER) AS Time,
           {_sparse_aggs()}
    FROM dedup
    WHERE CAST(ceil(m / {float(EVENTS_BIN_MINUTES)}) AS INTEGER) BETWEEN 0 AND {EVENTS_N_BINS - 1}
    GROUP BY 1, 2),
  ids AS (SELECT DISTINCT RecordID FROM sparse),
  dense AS (
    SELECT i.RecordID, CAST(t.Time AS INTEGER) AS Time, {", ".join(f's."{v}"' for v in V.raw_params)}
    FROM ids i CROSS JOIN range(0, {EVENTS_N_BINS}) AS t(Time)
    LEFT JOIN sparse s ON s.RecordID = i.RecordID AND s.Time = t.Time),
  prop AS (SELECT RecordID, Time, {_grid_cols()} FROM dense),
  grid AS (
    SELECT RecordID, Time, {", ".join(_rule_sql(v, V.grid_rules) + f' AS "{v}"' for v in V.grid_vars)}
    FROM prop)"""


def _grid_select(prefix="") -> str:
    return ", ".join(f'{r(prefix + chr(34) + v + chr(34))} AS "{v}"' for v in V.grid_vars)


SQL_EVENTS_GRID = f"WITH {SQL_GRID_CTE}\nSELECT RecordID, Time, {_grid_select()} FROM grid"


def _skew_sql(x: str) -> str:
    return (f"CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0 "
            f"ELSE skewness({x}) END")


def _stat_sql(stat: str, x: str) -> str:
    return {"mean": f"avg({x})", "std": f"stddev_samp({x})", "max": f"max({x})",
            "min": f"min({x})", "skew": _skew_sql(x)}[stat]


_STAT_NAMES = [f"{v}_{s}" for v in V.series_vars for s in STATS] + [f"{s}_first" for s in V.static_vars]

SQL_STAT_FEATURES = f"WITH {SQL_GRID_CTE},\n  feats AS (SELECT RecordID, " + ", ".join(
    [f'{_stat_sql(s, chr(34) + v + chr(34))} AS "{v}_{s}"' for v in V.series_vars for s in STATS]
    + [f'max("{s}") AS "{s}_first"' for s in V.static_vars]
) + " FROM grid GROUP BY RecordID),\n  med AS (SELECT " + ", ".join(
    f'median("{c}") AS "{c}"' for c in _STAT_NAMES) + " FROM feats)\nSELECT RecordID, " + ", ".join(
    f'{r(f"coalesce(f.{chr(34)}{c}{chr(34)}, m.{chr(34)}{c}{chr(34)})")} AS "{c}"' for c in _STAT_NAMES
) + " FROM feats f CROSS JOIN med m"

_MEAN_NAMES = list(V.series_vars) + list(V.static_vars)
SQL_MEAN_FEATURES = f"WITH {SQL_GRID_CTE},\n  feats AS (SELECT RecordID, " + ", ".join(
    [f'avg("{v}") AS "{v}"' for v in V.series_vars]
    + [f'max("{s}") AS "{s}"' for s in V.static_vars]
) + " FROM grid GROUP BY RecordID),\n  med AS (SELECT " + ", ".join(
    f'median("{c}") AS "{c}"' for c in _MEAN_NAMES) + " FROM feats)\nSELECT RecordID, " + ", ".join(
    f'{r(f"coalesce(f.{chr(34)}{c}{chr(34)}, m.{chr(34)}{c}{chr(34)})")} AS "{c}"' for c in _MEAN_NAMES
) + " FROM feats f CROSS JOIN med m"

SQL_FILLED_GRID = f"WITH {SQL_GRID_CTE},\n  med AS (SELECT " + ", ".join(
    f'median("{v}") AS "{v}"' for v in V.grid_vars) + " FROM grid),\n  ff AS (SELECT RecordID, Time, " + ", ".join(
    f'last_value("{v}" IGNORE NULLS) OVER (PARTITION BY RecordID ORDER BY Time ROWS BETWEEN '
    f'UNBOUNDED PRECEDING AND CURRENT ROW) AS "{v}"' for v in V.grid_vars
) + " FROM grid)\nSELECT RecordID, Time, " + ", ".join(
    f'{r(f"coalesce(ff.{chr(34)}{v}{chr(34)}, med.{chr(34)}{v}{chr(34)})")} AS "{v}"' for v in V.grid_vars
) + " FROM ff CROSS JOIN med"

SQL_DEDUP = (f"WITH {SQL_RECORDS}\nSELECT RecordID, Parameter, "
             f"{_HHMM} AS Time, {r('Value')} AS Value FROM dedup")

SQL_PIVOT = (f"WITH {SQL_RECORDS}\nSELECT RecordID, {_HHMM} AS Time, " + ", ".join(
    [f"{r(f'max(CASE WHEN Parameter = {chr(39)}{p}{chr(39)} THEN Value END)')} AS \"{p}\"" for p in V.raw_params]
    + [f"{r(f'max(CASE WHEN Parameter = {chr(39)}{s}{chr(39)} THEN Value END)')} AS \"{d}\""
       for s, d in V.static_copies.items()]) + " FROM dedup GROUP BY RecordID, m")


# ---------------------------------------------------------------- queries
@register("records_dedup", SQL_DEDUP)
def q_records_dedup(spark, sf_dir):
    """A1 on the events table read as minute-resolution records."""
    return rounded(deduplicated_records(spark, sf_dir).withColumn("Time", minutes_to_hhmm("Time")))


@register("records_pivot", SQL_PIVOT)
def q_records_pivot(spark, sf_dir):
    """A1 + A2 + P4: one wide row per (entity, minute)."""
    wide = pivot_records(deduplicated_records(spark, sf_dir), V)
    return rounded(wide.withColumn("Time", minutes_to_hhmm("Time")))


@register("events_grid", SQL_EVENTS_GRID)
def q_events_grid(spark, sf_dir):
    """Dedup -> daily bins -> binned means -> densify -> statics -> plausibility."""
    return rounded(events_grid_df(spark, sf_dir))


@register("grid_filled", SQL_FILLED_GRID)
def q_grid_filled(spark, sf_dir):
    """W1 + W2: forward fill per entity, then the median of the un-filled grid."""
    grid = events_grid_table(spark, sf_dir)
    return rounded(ffill_and_fill(grid, grid, V.grid_vars))


@register("grid_mean_filled", SQL_FILLED_GRID.replace("median(", "avg("))
def q_grid_mean_filled(spark, sf_dir):
    """W1 + A10: forward fill per entity, then the mean of the un-filled grid."""
    grid = events_grid_table(spark, sf_dir)
    return rounded(ffill_and_fill(grid, grid, V.grid_vars, how="mean"))


@register("entity_stat_features", SQL_STAT_FEATURES)
def q_entity_stat_features(spark, sf_dir):
    """A8 + A9 (+ P15): per-entity mean/std/max/min/skew, median filled."""
    grid = events_grid_df(spark, sf_dir)
    feats = cut_lineage(stat_features(grid, V.series_vars, V.model_static_vars))
    filled, _, _ = fill_features(feats, {})
    return rounded(filled)


@register("entity_mean_features", SQL_MEAN_FEATURES)
def q_entity_mean_features(spark, sf_dir):
    """A7 + A9: per-entity series means and first statics, median filled."""
    grid = events_grid_df(spark, sf_dir)
    feats = cut_lineage(mean_features(grid, V.series_vars, V.model_static_vars))
    filled, _, _ = fill_features(feats, {})
    return rounded(filled)
