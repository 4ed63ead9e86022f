"""E2 on the ``events`` table: records -> tuples -> scaled, indexed, packed sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.explore import length_stats
from wardline.operators.impute import ffill_and_fill
from wardline.operators.sample import class_weights, positive_counts
from wardline.operators.scale import (
    apply_minmax, apply_param_minmax, apply_standard, fit_minmax, fit_param_minmax, fit_standard,
)
from wardline.operators.features import stat_features
from wardline.operators.tuples import (
    apply_modality_map, event_tuples, fit_modality_map, pack_grid, pack_chunks, pack_triplets, pad_sequences,
    sequence_lengths, split_triplets,
)
from wardline.plans.grid_queries import (
    SQL_GRID_CTE, SQL_RECORDS, V, _STAT_NAMES, _stat_sql, deduplicated_records, events_grid_df, events_grid_table,
)
from wardline.plans.registry import r, register, rounded
from wardline.session import cut_lineage
from wardline.sources.tables import labels_as_outcomes, read_table
from wardline.vocab import EVENTS_BIN_MINUTES, EVENTS_N_BINS, ICU_MAX_SEQ_LEN

TIME_RANGE = float(EVENTS_N_BINS * EVENTS_BIN_MINUTES)


def events_tuples_df(spark, sf_dir):
    return event_tuples(deduplicated_records(spark, sf_dir), V)


def _tuple_rule_sql() -> str:
    parts = []
    for var, kind, bound in V.tuple_rules:
        op = {"below": "<", "above": ">", "at_most": "<="}[kind]
        parts.append(f"WHEN Parameter = '{var}' AND Value {op} {bound} THEN NULL")
    for var, d in V.default_fill.items():
        parts.insert(0, f"WHEN Parameter = '{var}' AND Value < 0 THEN {float(d)}")
    return "CASE " + " ".join(parts) + " ELSE Value END" if parts else "Value"


SQL_TUPLES_CTE = SQL_RECORDS + f""",
  tuples AS (
    SELECT RecordID, Parameter, CAST(m AS INTEGER) AS Time, Value FROM (
      SELECT RecordID, Parameter, m, {_tuple_rule_sql()} AS Value FROM dedup)
    WHERE Value IS NOT NULL)"""


@register("event_tuples", f"WITH {SQL_TUPLES_CTE}\nSELECT RecordID, Parameter, Time, {r('Value')} AS Value FROM tuples")
def q_event_tuples(spark, sf_dir):
    """E2 first half: dedup (A1) -> long plausibility (P7) -> minutes (F1) -> drop missing."""
    return rounded(events_tuples_df(spark, sf_dir))


@register("scaled_tuples", f"""WITH {SQL_TUPLES_CTE},
  fit AS (SELECT Parameter, min(Value) AS mn, max(Value) AS mx FROM tuples GROUP BY Parameter)
SELECT t.Parameter, t.RecordID, {r(f"t.Time / {TIME_RANGE}")} AS Time,
       {r("(t.Value - f.mn) / CASE WHEN f.mx > f.mn THEN f.mx - f.mn ELSE 1.0 END")} AS Value
FROM tuples t LEFT JOIN fit f ON t.Parameter = f.Parameter""")
def q_scaled_tuples(spark, sf_dir):
    """A22 + F4 + J8: per-parameter min-max fitted on training tuples, time / fixed range."""
    tup = events_tuples_df(spark, sf_dir)
    return rounded(apply_param_minmax(tup, fit_param_minmax(tup), time_range=TIME_RANGE))


SQL_MODALITY = """modality AS (
    SELECT Parameter, CAST(row_number() OVER (ORDER BY RecordID, Time, Parameter) AS INTEGER) AS z FROM (
      SELECT Parameter, arg_min(RecordID, (RecordID, Time, Parameter)) AS RecordID,
             arg_min(Time, (RecordID, Time, Parameter)) AS Time FROM tuples GROUP BY Parameter)
    UNION ALL SELECT '<PAD>' AS Parameter, 0 AS z)"""


@register("modality_map", f"WITH {SQL_TUPLES_CTE}, {SQL_MODALITY}\nSELECT Parameter, z FROM modality")
def q_modality_map(spark, sf_dir):
    """Parameter index by first appearance in (id, time, parameter) order; <PAD> = 0."""
    return fit_modality_map(events_tuples_df(spark, sf_dir))


SQL_PACKED = f"""WITH {SQL_TUPLES_CTE}, {SQL_MODALITY},
  scaled AS (
    SELECT t.RecordID, t.Parameter, t.Time AS tm, m.z, t.Time / {TIME_RANGE} AS t,
           (t.Value - f.mn) / CASE WHEN f.mx > f.mn THEN f.mx - f.mn ELSE 1.0 END AS v
    FROM tuples t
    JOIN (SELECT Parameter, min(Value) AS mn, max(Value) AS mx FROM tuples GROUP BY Parameter) f
      ON t.Parameter = f.Parameter
    LEFT JOIN modality m ON t.Parameter = m.Parameter),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY RecordID ORDER BY tm, Parameter) AS rn FROM scaled),
  packed AS (
    SELECT RecordID, list(t ORDER BY rn) AS t, list(z ORDER BY rn) AS z, list(v ORDER BY rn) AS v
    FROM ranked WHERE rn <= {ICU_MAX_SEQ_LEN} GROUP BY RecordID)"""


@register("padded_triplets", SQL_PACKED + """,
  mx AS (SELECT max(len(z)) AS n FROM packed)
SELECT RecordID,
  list_transform(list_concat(t, list_resize([]::DOUBLE[], n - len(t), -999.0)), lambda x: round(x, 6)) AS t,
  list_transform(list_concat(v, list_resize([]::DOUBLE[], n - len(v), -999.0)), lambda x: round(x, 6)) AS v,
  list_concat(z, list_resize([]::INTEGER[], n - len(z), 0)) AS z,
  list_transform(list_concat(z, list_resize([]::INTEGER[], n - len(z), 0)), lambda x: x = 0) AS mask
FROM packed CROSS JOIN mx""")
def q_padded_triplets(spark, sf_dir):
    """E2 second half: scale (A22, F4) -> index (A24, J7) -> pack (A6) -> truncate
    (Y1) -> split (Y2) -> pad and mask (Y3)."""
    return rounded(pad_sequences(split_triplets(packed_triplets(spark, sf_dir))))


def packed_triplets(spark, sf_dir):
    """Scaled and indexed triplets of each entity, at most ``ICU_MAX_SEQ_LEN``."""
    # fit (scaler, index, pad length) and apply all read the tuples: store them once
    tup = cut_lineage(events_tuples_df(spark, sf_dir))
    scaled = apply_param_minmax(tup.withColumn("tm", F.col("Time")), fit_param_minmax(tup),
                                time_range=TIME_RANGE)
    indexed = apply_modality_map(scaled, fit_modality_map(tup))
    return pack_triplets(indexed, order_time_col="tm", max_len=ICU_MAX_SEQ_LEN)


CHUNK = 16


@register("tuple_chunks", f"""WITH {SQL_TUPLES_CTE},
  ranked AS (SELECT RecordID, Time, Parameter, Value, row_number() OVER (PARTITION BY RecordID ORDER BY Time, Parameter) - 1 AS rn FROM tuples)
SELECT RecordID, rn // {CHUNK} AS chunk, list({{'t': CAST(Time AS DOUBLE), 'z': CAST(length(Parameter) AS INT), 'v': {r("Value")}}} ORDER BY rn) AS triplets
FROM ranked GROUP BY RecordID, rn // {CHUNK}""")
def q_tuple_chunks(spark, sf_dir):
    """A6 uncut: every tuple of every entity, in rows of at most 16 (the index
    is the length of the parameter's name here)."""
    tup = events_tuples_df(spark, sf_dir).withColumn("z", F.length("Parameter"))
    return rounded(pack_chunks(tup, chunk=CHUNK))


_P = [50, 75, 90, 95, 98, 99, 99.5, 99.9]


@register("sequence_length_stats", f"""WITH {SQL_TUPLES_CTE},
  lens AS (SELECT RecordID, count(*) AS length FROM tuples GROUP BY RecordID),
  s AS (SELECT CAST(min(length) AS DOUBLE) AS "min", CAST(max(length) AS DOUBLE) AS "max",
               avg(length) AS mean, count(length) AS n,
               {", ".join(f"quantile_cont(length, {p / 100}) AS p{str(p).replace('.', '_')}" for p in _P)}
        FROM lens)
SELECT {r('"min"')} AS "min", {r('"max"')} AS "max", {r('mean')} AS mean, n,
       {", ".join(r(f"p{str(p).replace('.', '_')}") + f" AS p{str(p).replace('.', '_')}" for p in _P)},
       {r('p50')} AS median,
       CAST(CASE WHEN p95 > 0 THEN ceil(p95 / 64) * 64 ELSE 64 END AS BIGINT) AS max_len_p95,
       CAST(CASE WHEN p99 > 0 THEN ceil(p99 / 64) * 64 ELSE 64 END AS BIGINT) AS max_len_p99
FROM s""")
def q_sequence_length_stats(spark, sf_dir):
    """A18 + A19: tuple counts per entity -> exact percentiles and padding suggestions."""
    lengths = cut_lineage(sequence_lengths(events_tuples_df(spark, sf_dir)))  # one row per entity
    return rounded(length_stats(lengths))


_GRID_VARS_SCALED = [v for v in V.grid_vars]


@register("grid_tensor", f"""WITH {SQL_GRID_CTE},
  med AS (SELECT {", ".join(f'median("{v}") AS "{v}"' for v in V.grid_vars)} FROM grid),
  ff AS (SELECT RecordID, Time, {", ".join(
      f'last_value("{v}" IGNORE NULLS) OVER (PARTITION BY RecordID ORDER BY Time ROWS BETWEEN '
      f'UNBOUNDED PRECEDING AND CURRENT ROW) AS "{v}"' for v in V.grid_vars)} FROM grid),
  filled AS (SELECT RecordID, Time, {", ".join(f'coalesce(ff."{v}", med."{v}") AS "{v}"' for v in V.grid_vars)}
             FROM ff CROSS JOIN med),
  mm AS (SELECT {", ".join(f'min("{v}") AS "mn_{v}", max("{v}") AS "mx_{v}"' for v in V.grid_vars)} FROM filled)
SELECT RecordID, list(list_transform([{", ".join(
    f'(f."{v}" - "mn_{v}") / CASE WHEN "mx_{v}" > "mn_{v}" THEN "mx_{v}" - "mn_{v}" ELSE 1.0 END'
    for v in V.grid_vars)}], lambda x: round(x, 6)) ORDER BY Time) AS x
FROM filled f CROSS JOIN mm GROUP BY RecordID""")
def q_grid_tensor(spark, sf_dir):
    """W1 + W2 -> F3 (min-max fitted on the filled training grid) -> A4 (time x feature arrays)."""
    grid = events_grid_table(spark, sf_dir)
    filled = cut_lineage(ffill_and_fill(grid, grid, V.grid_vars))
    scaled = apply_minmax(filled, fit_minmax(filled, V.grid_vars))
    return rounded(pack_grid(scaled, V.grid_vars))


@register("standard_scaled_features", f"""WITH {SQL_GRID_CTE},
  feats AS (SELECT RecordID, {", ".join(
      [f'{_stat_sql(s, chr(34) + v + chr(34))} AS "{v}_{s}"' for v in V.series_vars for s in ("mean", "std", "max", "min", "skew")]
      + [f'max("{s}") AS "{s}_first"' for s in V.static_vars])} FROM grid GROUP BY RecordID),
  st AS (SELECT {", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in _STAT_NAMES)} FROM feats)
SELECT RecordID, {", ".join(
    r(f'(f."{c}" - "m_{c}") / CASE WHEN "s_{c}" > 0 THEN "s_{c}" ELSE 1.0 END') + f' AS "{c}"' for c in _STAT_NAMES)}
FROM feats f CROSS JOIN st""")
def q_standard_scaled_features(spark, sf_dir):
    """A23 + F5: per-entity features standardised with population std (nulls kept)."""
    feats = cut_lineage(stat_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars))
    cols = [c for c in feats.columns if c != "RecordID"]
    return rounded(apply_standard(feats, fit_standard(feats, cols)))


@register("class_weights", f"""WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality),
  t AS (SELECT sum(n) AS total, count(*) AS k,
               sum(n) FILTER (WHERE label = 0) AS n_neg, sum(n) FILTER (WHERE label = 1) AS n_pos FROM c)
SELECT label, n, {r('1.0 / n')} AS inverse_weight, {r('total / (k * n)')} AS balanced_weight,
       {r('n_neg / n_pos')} AS pos_weight FROM c CROSS JOIN t""")
def q_class_weights(spark, sf_dir):
    """A20 + A21: class counts, inverse-frequency and balanced weights, pos_weight."""
    lab = labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))
    return rounded(class_weights(lab))


@register("positive_counts", """SELECT d.lang AS "group", CAST(sum(l.quality) AS BIGINT) AS n_positive,
  count(*) AS n FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY d.lang""")
def q_positive_counts(spark, sf_dir):
    """Positives and totals per group (per split in the reference; per language here)."""
    lab = labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "lang"])
    joined = lab.join(docs.withColumnRenamed("doc_id", "RecordID"), "RecordID")
    return positive_counts(joined.withColumnRenamed("lang", "group"), "group")
