"""E4 on the ``events`` table: per-entity statistics -> text summaries -> prompts."""

from __future__ import annotations

from wardline.operators.features import stat_features
from wardline.operators.text import (
    OUTCOME_SEP, PROMPT_HEAD, PROMPT_MIDDLE, PROMPT_TAIL, RATING_DIED, RATING_SURVIVED,
    FEWSHOT_FIRST, FEWSHOT_WINDOW, feature_phrase, fewshot_examples, prompts, summaries,
)
from wardline.plans.grid_queries import SQL_GRID_CTE, V, _STAT_NAMES, _stat_sql, events_grid_df
from wardline.plans.explore_queries import _OUTCOME_SQL
from wardline.plans.registry import register
from wardline.sources.tables import events_outcomes, read_table
from wardline.operators.features import STATS

FEATURES = _STAT_NAMES


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_FEATS_SQL = ("feats AS (SELECT RecordID, " + ", ".join(
    [f'{_stat_sql(s, chr(34) + v + chr(34))} AS "{v}_{s}"' for v in V.series_vars for s in STATS]
    + [f'max("{s}") AS "{s}_first"' for s in V.static_vars]) + " FROM grid GROUP BY RecordID)")

_SUMMARY_SQL = "concat_ws('. ', " + ", ".join(
    f"CASE WHEN \"{f}\" IS NOT NULL THEN {_sql_str(feature_phrase(f, V.descriptions) + ' ')} || "
    f"CAST(round_even(round(CAST(\"{f}\" AS DOUBLE), 9), 2) AS VARCHAR) END" for f in FEATURES) + ") || '.'"

SQL_SUMMARIES_CTE = f"{SQL_GRID_CTE}, {_FEATS_SQL},\n  summ AS (SELECT RecordID, {_SUMMARY_SQL} AS summary FROM feats)"

SQL_FEWSHOT_CTE = SQL_SUMMARIES_CTE + f""", {_OUTCOME_SQL},
  head AS (SELECT s.RecordID, s.summary, o.label,
                  row_number() OVER (ORDER BY s.RecordID) - 1 AS position
           FROM summ s LEFT JOIN outc o ON s.RecordID = o.RecordID ORDER BY s.RecordID LIMIT {FEWSHOT_WINDOW}),
  shots AS (SELECT RecordID, position,
                   summary || {_sql_str(OUTCOME_SEP)} || CASE WHEN label = 0 THEN '{RATING_SURVIVED}' ELSE '{RATING_DIED}' END AS line
            FROM head WHERE position < {FEWSHOT_FIRST} OR label = 1)"""


def _summ(spark, sf_dir):
    feats = stat_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars)
    return summaries(feats, FEATURES, V.descriptions)


def _outcomes(spark, sf_dir):
    return events_outcomes(read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"]))


@register("entity_summaries", f"WITH {SQL_SUMMARIES_CTE}\nSELECT RecordID, summary FROM summ")
def q_entity_summaries(spark, sf_dir):
    """F8 + F9: per-entity statistics (A8, not filled) written as one sentence list."""
    return _summ(spark, sf_dir)


@register("fewshot_examples", f"WITH {SQL_FEWSHOT_CTE}\nSELECT RecordID, CAST(position AS INTEGER) AS position, line FROM shots")
def q_fewshot_examples(spark, sf_dir):
    """W4 + F10: first five entities and the positives among the first 32, with outcome ratings."""
    return fewshot_examples(_summ(spark, sf_dir), _outcomes(spark, sf_dir))


@register("prompts", f"""WITH {SQL_FEWSHOT_CTE},
  block AS (SELECT string_agg(line, chr(10) ORDER BY position) AS ex FROM shots)
SELECT s.RecordID, {_sql_str(PROMPT_HEAD)} || b.ex || {_sql_str(PROMPT_MIDDLE)} || s.summary || {_sql_str(PROMPT_TAIL)} AS prompt
FROM summ s, block b""")
def q_prompts(spark, sf_dir):
    """instruction + few-shot block + summary for every entity."""
    summ = _summ(spark, sf_dir)
    return prompts(summ, fewshot_examples(summ, _outcomes(spark, sf_dir)))
