"""Reports that fit on the training split and apply to all splits, and the
key-wise, reply and sequence reports beside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.explore import box_summary, outlier_rows
from wardline.operators.features import STATS, fill_features, stat_features
from wardline.operators.impute import ffill_and_fill
from wardline.operators.joins import (
    TRAIN, concat_splits, join_feature_sets, keep_members, label_lookup, split_name, splits_of,
)
from wardline.operators.metrics import best_epoch
from wardline.operators.sample import positive_counts
from wardline.operators.scale import (
    apply_minmax, apply_param_minmax, apply_standard, fit_minmax, fit_param_minmax, fit_standard,
)
from wardline.operators.text import clean_response, response_score, score_predictions
from wardline.operators.tuples import (
    apply_modality_map, fit_modality_map, last_step, pack_grid, pack_triplets, pad_sequences, sort_tuples,
    split_triplets, vocabulary_size,
)
from wardline.plans.grid_queries import SQL_GRID_CTE, V, _STAT_NAMES, _stat_sql, events_grid_df, events_grid_table
from wardline.plans.registry import r, register, rounded
from wardline.plans.tuple_queries import SQL_TUPLES_CTE, TIME_RANGE, events_tuples_df
from wardline.session import cut_lineage
from wardline.sources.tables import events_outcomes, labels_as_outcomes, read_table, wide_to_vector
from wardline.vocab import ICU_MAX_SEQ_LEN

SQL_SPLIT = "CASE WHEN RecordID % 10 < 7 THEN 'a' WHEN RecordID % 10 = 7 THEN 'b' ELSE 'c' END"
_IS_TRAIN = "RecordID % 10 < 7"


def _q(name: str) -> str:
    return f'"{name}"'


_SQL_FEATS = f"""WITH {SQL_GRID_CTE},
  feats AS (SELECT RecordID, {", ".join(
      [f"{_stat_sql(s, _q(v))} AS {_q(f'{v}_{s}')}" for v in V.series_vars for s in STATS]
      + [f"max({_q(s)}) AS {_q(s + '_first')}" for s in V.static_vars])} FROM grid GROUP BY RecordID)"""


def _features(spark, sf_dir):
    return cut_lineage(stat_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars))


@register("split_stat_features", f"""{_SQL_FEATS},
  med AS (SELECT {", ".join(f"median({_q(c)}) AS {_q(c)}" for c in _STAT_NAMES)} FROM feats WHERE {_IS_TRAIN})
SELECT f.RecordID, {SQL_SPLIT.replace("RecordID", "f.RecordID")} AS split,
       {", ".join(r(f"coalesce(f.{_q(c)}, m.{_q(c)})") + f" AS {_q(c)}" for c in _STAT_NAMES)} FROM feats f CROSS JOIN med m""")
def q_split_stat_features(spark, sf_dir):
    """A8 + A9 + P15 + U2: medians of the training split fill every split."""
    parts = splits_of(_features(spark, sf_dir))
    train, others, _ = fill_features(parts.pop(TRAIN), parts)
    return rounded(concat_splits({TRAIN: train, **others}))


@register("split_standard_features", f"""{_SQL_FEATS},
  st AS (SELECT {", ".join(f"avg({_q(c)}) AS {_q('m_' + c)}, stddev_pop({_q(c)}) AS {_q('s_' + c)}" for c in _STAT_NAMES)}
         FROM feats WHERE {_IS_TRAIN})
SELECT RecordID, {SQL_SPLIT} AS split, {", ".join(
    r(f"({_q(c)} - {_q('m_' + c)}) / CASE WHEN {_q('s_' + c)} > 0 THEN {_q('s_' + c)} ELSE 1.0 END") + f" AS {_q(c)}"
    for c in _STAT_NAMES)} FROM feats CROSS JOIN st""")
def q_split_standard_features(spark, sf_dir):
    """A23 + F5: mean and deviation of the training split scale every split."""
    feats = _features(spark, sf_dir)
    fitted = fit_standard(splits_of(feats)[TRAIN], [c for c in feats.columns if c != "RecordID"])
    return rounded(apply_standard(feats, fitted).withColumn("split", split_name()))


@register("split_grid_tensor", f"""WITH {SQL_GRID_CTE},
  med AS (SELECT {", ".join(f"median({_q(v)}) AS {_q(v)}" for v in V.grid_vars)} FROM grid WHERE {_IS_TRAIN}),
  ff AS (SELECT RecordID, Time, {", ".join(
      f"last_value({_q(v)} IGNORE NULLS) OVER (PARTITION BY RecordID ORDER BY Time ROWS BETWEEN "
      f"UNBOUNDED PRECEDING AND CURRENT ROW) AS {_q(v)}" for v in V.grid_vars)} FROM grid),
  filled AS (SELECT RecordID, Time, {", ".join(f"coalesce(ff.{_q(v)}, med.{_q(v)}) AS {_q(v)}" for v in V.grid_vars)}
             FROM ff CROSS JOIN med),
  mm AS (SELECT {", ".join(f"min({_q(v)}) AS {_q('mn_' + v)}, max({_q(v)}) AS {_q('mx_' + v)}" for v in V.grid_vars)}
         FROM filled WHERE {_IS_TRAIN})
SELECT RecordID, {SQL_SPLIT} AS split, list(list_transform([{", ".join(
    f"({_q(v)} - {_q('mn_' + v)}) / CASE WHEN {_q('mx_' + v)} > {_q('mn_' + v)} THEN {_q('mx_' + v)} - {_q('mn_' + v)} ELSE 1.0 END"
    for v in V.grid_vars)}], lambda x: round(x, 6)) ORDER BY Time) AS x
FROM filled CROSS JOIN mm GROUP BY RecordID""")
def q_split_grid_tensor(spark, sf_dir):
    """W1 + W2 + F3 + A4: medians and ranges of the training split for every split."""
    grid = events_grid_table(spark, sf_dir)
    filled = cut_lineage(ffill_and_fill(grid, splits_of(grid)[TRAIN], V.grid_vars))
    scaled = apply_minmax(filled, fit_minmax(splits_of(filled)[TRAIN], V.grid_vars))
    return rounded(pack_grid(scaled, V.grid_vars).withColumn("split", split_name()))


SQL_SPLIT_PACKED = f"""WITH {SQL_TUPLES_CTE},
  fit AS (SELECT Parameter, min(Value) AS mn, max(Value) AS mx FROM tuples WHERE {_IS_TRAIN} GROUP BY Parameter),
  firsts AS (SELECT Parameter, min((RecordID, Time, Parameter)) AS k FROM tuples WHERE {_IS_TRAIN} GROUP BY Parameter),
  modality AS (SELECT Parameter, CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS z FROM firsts),
  scaled AS (SELECT t.RecordID, t.Parameter, t.Time AS tm, m.z, t.Time / {TIME_RANGE} AS t,
               (t.Value - f.mn) / CASE WHEN f.mx > f.mn THEN f.mx - f.mn ELSE 1.0 END AS v
             FROM tuples t LEFT JOIN fit f USING (Parameter) LEFT JOIN modality m USING (Parameter)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY RecordID ORDER BY tm, Parameter) AS rn FROM scaled),
  packed AS (SELECT RecordID, list(t ORDER BY rn) AS t, list(z ORDER BY rn) AS z, list(v ORDER BY rn) AS v
             FROM ranked WHERE rn <= {ICU_MAX_SEQ_LEN} GROUP BY RecordID)"""


def _split_packed(spark, sf_dir):
    tup = cut_lineage(events_tuples_df(spark, sf_dir))
    train = splits_of(tup)[TRAIN]
    scaled = apply_param_minmax(tup.withColumn("tm", F.col("Time")), fit_param_minmax(train), time_range=TIME_RANGE)
    indexed = apply_modality_map(scaled, fit_modality_map(train))
    return split_triplets(pack_triplets(indexed, order_time_col="tm", max_len=ICU_MAX_SEQ_LEN))


@register("split_scaled_tuples", f"""{SQL_SPLIT_PACKED}
SELECT RecordID, {SQL_SPLIT} AS split, Parameter, {r("t")} AS Time, {r("v")} AS Value FROM scaled""")
def q_split_scaled_tuples(spark, sf_dir):
    """A22 + F4 + J8: parameter ranges of the training split for every split;
    values outside them leave [0, 1], a parameter unseen in training gets null."""
    tup = cut_lineage(events_tuples_df(spark, sf_dir))
    scaled = apply_param_minmax(tup, fit_param_minmax(splits_of(tup)[TRAIN]), time_range=TIME_RANGE)
    return rounded(scaled.select("RecordID", split_name().alias("split"), "Parameter", "Time", "Value"))


@register("split_padded_triplets", f"""{SQL_SPLIT_PACKED},
  mx AS (SELECT max(len(z)) AS n FROM packed)
SELECT RecordID, {SQL_SPLIT} AS split,
  list_transform(list_concat(t, list_resize([]::DOUBLE[], n - len(t), -999.0)), lambda x: round(x, 6)) AS t,
  list_transform(list_concat(v, list_resize([]::DOUBLE[], n - len(v), -999.0)), lambda x: round(x, 6)) AS v,
  list_concat(z, list_resize([]::INTEGER[], n - len(z), 0)) AS z,
  list_transform(list_concat(z, list_resize([]::INTEGER[], n - len(z), 0)), lambda x: x = 0) AS mask
FROM packed CROSS JOIN mx""")
def q_split_padded_triplets(spark, sf_dir):
    """Scaler and parameter index of the training split
    for every split."""
    packed = cut_lineage(_split_packed(spark, sf_dir))
    return rounded(pad_sequences(packed).withColumn("split", split_name()))


@register("last_steps", f"""{SQL_SPLIT_PACKED}
SELECT RecordID, {r("t[-1]")} AS t_last, z[-1] AS z_last, {r("v[-1]")} AS v_last FROM packed""")
def q_last_steps(spark, sf_dir):
    """The last step of each entity's sequence."""
    packed = _split_packed(spark, sf_dir)
    for c in ("t", "z", "v"):
        packed = last_step(packed, c)
    return rounded(packed.drop("t", "z", "v"))


@register("sorted_tuples", f"WITH {SQL_TUPLES_CTE} SELECT RecordID, Parameter, Time, {r('Value')} AS Value FROM tuples ORDER BY RecordID, Time, Parameter")
def q_sorted_tuples(spark, sf_dir):
    """O1: tuples in (entity, time, parameter) order."""
    return sort_tuples(rounded(events_tuples_df(spark, sf_dir)))


@register("vocabulary_size", f"WITH {SQL_TUPLES_CTE} SELECT CAST(count(DISTINCT Parameter) + 1 AS INTEGER) AS size FROM tuples")
def q_vocabulary_size(spark, sf_dir):
    """Number of parameter indices, checked against the configured vocabulary."""
    size = vocabulary_size(fit_modality_map(events_tuples_df(spark, sf_dir)), configured=len(V.raw_params) + 1)
    return spark.createDataFrame([(size,)], "size int")


def _outcomes(spark, sf_dir):
    return events_outcomes(read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"]))


_SQL_OUTCOMES = ("o AS (SELECT user_id AS RecordID, max(CASE WHEN event_type = 'error' AND value > 200 THEN 1 ELSE 0 END) AS label "
                 "FROM events GROUP BY user_id)")


@register("split_positive_counts", f"""WITH {_SQL_OUTCOMES}
SELECT {SQL_SPLIT} AS split, CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS n FROM o GROUP BY 1""")
def q_split_positive_counts(spark, sf_dir):
    """J2 + P17 + A26: outcomes by checked key lookup, positives per split."""
    ids = read_table(spark, sf_dir, "events", columns=["user_id"]).select(
        F.col("user_id").cast("long").alias("RecordID")).distinct()
    return positive_counts(label_lookup(ids, _outcomes(spark, sf_dir)).withColumn("split", split_name()))


@register("labelled_documents", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_labelled_documents(spark, sf_dir):
    """J4 + P10: documents that have a label, by semi join."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "lang", "source"])
    return keep_members(docs, read_table(spark, sf_dir, "labels", columns=["doc_id"]), "doc_id")


_SETS = list(V.raw_params)


@register("joined_feature_sets", f"""SELECT user_id AS RecordID, {", ".join(
    f"{r(f'avg(value) FILTER (WHERE event_type = {chr(39)}{p}{chr(39)})')} AS {_q(p + '_mean')}" for p in _SETS)}
FROM events WHERE event_type IN ({", ".join(f"'{p}'" for p in _SETS)}) GROUP BY user_id""")
def q_joined_feature_sets(spark, sf_dir):
    """One table of means per variable, outer joined on the entity."""
    ev = read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"])
    tables = [ev.where(F.col("event_type") == p).groupBy(F.col("user_id").cast("long").alias("RecordID"))
              .agg(F.avg("value").alias(f"{p}_mean")) for p in _SETS]
    return rounded(join_feature_sets(tables))


@register("feature_vectors", f"""{_SQL_FEATS}
SELECT RecordID, list_transform([{", ".join(f"CAST({_q(v + '_mean')} AS FLOAT)" for v in V.series_vars)}],
  lambda x: round(CAST(x AS DOUBLE), 6)) AS embedding FROM feats""")
def q_feature_vectors(spark, sf_dir):
    """Wide feature columns as one float array."""
    feats = stat_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars)
    return rounded(wide_to_vector(feats, "RecordID", [f"{v}_mean" for v in V.series_vars]))


@register("outlier_documents", """WITH b AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT doc_id, n_chars FROM documents, b WHERE n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1)""")
def q_outlier_documents(spark, sf_dir):
    """The documents whose length lies outside the whiskers."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "n_chars"])
    box = box_summary(docs, ["n_chars"]).first()  # one row
    return outlier_rows(docs, "n_chars", box["q1"], box["q3"])


@register("reply_scores", """SELECT l.doc_id AS RecordID, l.quality AS label, round(1.0 - (d.n_chars % 10 + 1) / 10.0::DOUBLE, 6) AS probability,
  CASE WHEN d.n_chars % 10 + 1 < 5 THEN 1 ELSE 0 END AS pred
FROM labels l JOIN documents d USING (doc_id)""")
def q_reply_scores(spark, sf_dir):
    """F12 + F13 + M20: reply chunks -> rating -> probability and class, joined
    to the outcomes.  Stand-in replies: a rating from the text's length, with
    blanks around it, in three chunks."""
    docs = read_table(spark, sf_dir, "documents", columns=["doc_id", "n_chars"])
    chunks = F.array(F.lit("\n "), (F.col("n_chars") % 10 + 1).cast("string"), F.lit(" \n"))
    replies = docs.select(F.col("doc_id").cast("long").alias("RecordID"), chunks.alias("chunks"))
    rated = replies.withColumn("reply", clean_response("chunks")).withColumn("Prediction", response_score("reply"))
    labels = labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))
    return rounded(score_predictions(rated.select("RecordID", "Prediction"), labels))


@register("best_days", f"""WITH h AS (SELECT event_type AS run, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS INTEGER) AS epoch, count(*) AS auroc
  FROM events GROUP BY ALL)
SELECT run, CAST(min(epoch) FILTER (WHERE auroc = m) AS INTEGER) AS best_epoch, max(auroc) AS best_auroc
FROM (SELECT *, max(auroc) OVER (PARTITION BY run) AS m FROM h) GROUP BY run""")
def q_best_days(spark, sf_dir):
    """Per run the epoch of the best metric, the earliest of equals.
    Stand-in history: events per type (run) and day (epoch)."""
    ev = read_table(spark, sf_dir, "events", columns=["ts", "event_type"])
    day = F.datediff(F.to_date(F.expr("CAST(ts AS TIMESTAMP_NTZ)")), F.lit("2024-01-01").cast("date"))
    history = ev.groupBy(F.col("event_type").alias("run"), day.alias("epoch")).agg(F.count(F.lit(1)).alias("auroc"))
    return best_epoch(history, "auroc", "epoch", run_cols=["run"])
