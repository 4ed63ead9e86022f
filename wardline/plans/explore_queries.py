"""Exploration reports (A11-A17, J1, P11, P12) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.explore import (
    box_summary, correlation_matrix, histogram, null_and_distinct_counts,
)
from wardline.operators.features import grouped_mean, grouped_variance, mean_features
from wardline.operators.quantiles import exact_quantiles
from wardline.plans.grid_queries import SQL_GRID_CTE, V, events_grid_df
from wardline.plans.registry import r, register, rounded
from wardline.sources.tables import events_outcomes, labels_as_outcomes, read_table

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _long_sql(table: str, cols, by=()) -> str:
    by_sel = "".join(f"{b}, " for b in by)
    return " UNION ALL ".join(
        f"SELECT {by_sel}'{c}' AS \"column\", CAST(\"{c}\" AS DOUBLE) AS value FROM {table} "
        f"WHERE \"{c}\" IS NOT NULL AND NOT isnan(CAST(\"{c}\" AS DOUBLE))" for c in cols)


def _hist_sql(long_from: str, bins: int, by=(), prelude: str = "") -> str:
    keys = ", ".join(list(by) + ['"column"'])
    kj = " AND ".join(f"l.{k} = g.{k}" for k in list(by) + ['"column"'])
    kj2 = " AND ".join(f"s.{k} = c.{k}" for k in list(by) + ['"column"'])
    sel = ", ".join(f"s.{k}" for k in list(by) + ['"column"'])
    return f"""WITH {prelude} long AS ({long_from}),
  rng0 AS (SELECT {keys}, min(value) AS mn, max(value) AS mx FROM long GROUP BY {keys}),
  rng AS (SELECT {keys}, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                 CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rng0),
  cnt AS (SELECT {", ".join("l." + k for k in list(by) + ['"column"'])},
                 CAST(least(floor((l.value - g.lo) * {float(bins)} / (g.hi - g.lo)), {bins - 1}) AS INTEGER) AS bin,
                 count(*) AS n
          FROM long l JOIN rng g ON {kj} GROUP BY ALL),
  skel AS (SELECT g.*, CAST(b.bin AS INTEGER) AS bin FROM rng g CROSS JOIN range(0, {bins}) AS b(bin))
SELECT {sel}, s.bin,
       {r(f"s.lo + s.bin * ((s.hi - s.lo) / {float(bins)})")} AS lower,
       {r(f"s.lo + (s.bin + 1) * ((s.hi - s.lo) / {float(bins)})")} AS upper,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM skel s LEFT JOIN cnt c ON {kj2} AND s.bin = c.bin"""


@register("lineitem_histogram", _hist_sql(_long_sql("lineitem", LINE_COLS), 10))
def q_lineitem_histogram(spark, sf_dir):
    """10 equal-width bins per numeric column (last bin closed)."""
    li = read_table(spark, sf_dir, "lineitem", columns=LINE_COLS)
    return rounded(histogram(li, LINE_COLS, bins=10))


_DOC_LABEL_SQL = ("doc AS (SELECT d.n_chars, l.quality AS label FROM documents d "
                  "LEFT JOIN labels l ON d.doc_id = l.doc_id),")


def _docs_with_labels(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "n_chars"])
    lab = labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))
    # Left join keeps every document; documents without a label have label null
    return docs.join(lab.withColumnRenamed("RecordID", "doc_id"), "doc_id", "left")


@register("class_histogram",
          _hist_sql("SELECT label, 'n_chars' AS \"column\", CAST(n_chars AS DOUBLE) AS value FROM doc "
                    "WHERE label IS NOT NULL AND n_chars IS NOT NULL", 40, by=("label",), prelude=_DOC_LABEL_SQL))
def q_class_histogram(spark, sf_dir):
    """40 bins of a feature per outcome class, each class on its own range."""
    d = _docs_with_labels(spark, sf_dir).where(F.col("label").isNotNull())
    return rounded(histogram(d, ["n_chars"], bins=40, by=["label"]))


@register("class_means", f"WITH {_DOC_LABEL_SQL[:-1]} SELECT label, {r('avg(n_chars)')} AS n_chars "
                         "FROM doc WHERE label IS NOT NULL GROUP BY label")
def q_class_means(spark, sf_dir):
    """Mean of a feature per outcome class (the reference lines of A15)."""
    d = _docs_with_labels(spark, sf_dir).where(F.col("label").isNotNull())
    return rounded(grouped_mean(d, "label", ["n_chars"]))


@register("lineitem_box_summary", "WITH long AS (" + _long_sql("lineitem", LINE_COLS) + """),
  q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1)
SELECT l."column", """ + ", ".join([
    r("q.q1") + " AS q1", r("q.median") + " AS median", r("q.q3") + " AS q3",
    r("min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END)") + " AS whisker_low",
    r("max(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END)") + " AS whisker_high",
    "count(*) FILTER (WHERE NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS n_outliers",
    "count(*) AS n", r("q.q3 - q.q1") + " AS iqr"]) + """
FROM long l JOIN q ON l."column" = q."column" GROUP BY l."column", q.q1, q.median, q.q3""")
def q_lineitem_box_summary(spark, sf_dir):
    """Quartiles, IQR, whiskers and outlier counts per column."""
    li = read_table(spark, sf_dir, "lineitem", columns=LINE_COLS)
    return rounded(box_summary(li, LINE_COLS))


_REFINED_P = [0.005, 0.25, 0.5, 0.9, 0.995]
_CAPPED = {"l_quantity": 30.0, "l_discount": 0.05}


@register("capped_column_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", " + ", ".join(r(f"quantile_cont(least({c}, {cap}), {p})") + f" AS q{i}" for i, p in enumerate(_REFINED_P))
    + " FROM lineitem" for c, cap in _CAPPED.items()))
def q_capped_column_quantiles(spark, sf_dir):
    """Quantiles of columns with a heavy maximum, refined from brackets of at most 200 values."""
    li = read_table(spark, sf_dir, "lineitem", columns=list(_CAPPED))
    capped = li.select(*[F.least(F.col(c).cast("double"), F.lit(cap)).alias(c) for c, cap in _CAPPED.items()])
    got = exact_quantiles(capped, list(_CAPPED), _REFINED_P, max_exact=200, n_buckets=8)
    return rounded(spark.createDataFrame([(c, *map(float, q)) for c, q in got.items()],
                                         "column string, " + ", ".join(f"q{i} double" for i in range(len(_REFINED_P)))))


_MEAN_COLS = list(V.series_vars) + list(V.model_static_vars)
_ENTITY_MEANS_SQL = ("ent AS (SELECT RecordID, " + ", ".join(
    [f'avg("{v}") AS "{v}"' for v in V.series_vars] + [f'max("{s}") AS "{s}"' for s in V.model_static_vars])
    + " FROM grid GROUP BY RecordID)")


def _corr_sql(src: str, by=()) -> str:
    parts = []
    by_sel = "".join(f"{b}, " for b in by)
    gb = (" GROUP BY " + ", ".join(by)) if by else ""
    for i, a in enumerate(_MEAN_COLS):
        for b in _MEAN_COLS[i:]:
            parts.append(f"SELECT {by_sel}'{a}' AS var1, '{b}' AS var2, {r(f'corr({chr(34)}{a}{chr(34)}, {chr(34)}{b}{chr(34)})')} AS corr FROM {src}{gb}")
            if a != b:
                parts.append(f"SELECT {by_sel}'{b}' AS var1, '{a}' AS var2, {r(f'corr({chr(34)}{a}{chr(34)}, {chr(34)}{b}{chr(34)})')} AS corr FROM {src}{gb}")
    return " UNION ALL ".join(parts)


@register("entity_correlation", f"WITH {SQL_GRID_CTE}, {_ENTITY_MEANS_SQL}\n" + _corr_sql("ent"))
def q_entity_correlation(spark, sf_dir):
    """Correlation matrix of per-entity means and statics (pairwise complete)."""
    ent = mean_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars)
    return rounded(correlation_matrix(ent, _MEAN_COLS))


_OUTCOME_SQL = ("outc AS (SELECT user_id AS RecordID, max(CASE WHEN event_type = 'error' AND value > 200.0 "
                "THEN 1 ELSE 0 END) AS label FROM events GROUP BY user_id)")


@register("entity_correlation_by_outcome",
          f"WITH {SQL_GRID_CTE}, {_ENTITY_MEANS_SQL}, {_OUTCOME_SQL},\n"
          "entl AS (SELECT e.*, o.label FROM ent e JOIN outc o USING (RecordID))\n" + _corr_sql("entl", ("label",)))
def q_entity_correlation_by_outcome(spark, sf_dir):
    """A13 per outcome class."""
    ent = mean_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars)
    out = events_outcomes(read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"]))
    return rounded(correlation_matrix(ent.join(out, "RecordID"), _MEAN_COLS, by=["label"]))


@register("entity_variance_by_outcome",
          f"WITH {SQL_GRID_CTE}, {_OUTCOME_SQL}\nSELECT g.RecordID, o.label, " + ", ".join(
              f'{r(f"var_samp(g.{chr(34)}{v}{chr(34)})")} AS "{v}"' for v in V.series_vars)
          + " FROM grid g LEFT JOIN outc o ON g.RecordID = o.RecordID GROUP BY g.RecordID, o.label")
def q_entity_variance_by_outcome(spark, sf_dir):
    """J1 + A12: grid left-joined with outcomes, sample variance per (entity, class)."""
    grid = events_grid_df(spark, sf_dir)
    out = events_outcomes(read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"]))
    return rounded(grouped_variance(grid.join(out, "RecordID", "left"), ["RecordID", "label"], V.series_vars))


@register("entity_grouped_mean",
          f"WITH {SQL_GRID_CTE}\nSELECT RecordID, " + ", ".join(
              f'{r(f"avg({chr(34)}{v}{chr(34)})")} AS "{v}"' for v in ["Time"] + V.grid_vars)
          + " FROM grid GROUP BY RecordID")
def q_entity_grouped_mean(spark, sf_dir):
    """Mean of every grid column per entity."""
    grid = events_grid_df(spark, sf_dir)
    return rounded(grouped_mean(grid, "RecordID", ["Time"] + V.grid_vars))


@register("grid_null_counts",
          f"WITH {SQL_GRID_CTE}\n" + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS n_null, "
              f"count(DISTINCT {'round(' + chr(34) + c + chr(34) + ', 9)' if c not in ('RecordID', 'Time') else chr(34) + c + chr(34)}) + CASE WHEN count(*) FILTER (WHERE \"{c}\" IS NULL) > 0 THEN 1 ELSE 0 END "
              f"AS n_distinct FROM grid" for c in ["RecordID", "Time"] + V.grid_vars))
def q_grid_null_counts(spark, sf_dir):
    """P11 + P12: missing and distinct counts per grid column."""
    return null_and_distinct_counts(events_grid_df(spark, sf_dir), digits=9)
