"""Sampling, augmentation and model reports.

Random operators draw from MD5 digits, which their SQL twins repeat; fitted
models have no SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wardline.functions.randomness import hash_uniform, sql_normal, sql_uniform
from wardline.operators.augment import (
    GRID_NOISE_STD, GRID_TIME_MASK_RATIO, TRIPLET_DROPOUT, TRIPLET_JITTER_STD, TRIPLET_TIME_SHIFT, add_positional_encoding, feature_masking, grid_views, info_nce, mean_over_time, segment_permutation,
    time_encoding, triplet_views,
)
from wardline.operators.explore import histogram
from wardline.operators.features import fill_features, stat_features
from wardline.operators.impute import ffill_and_fill
from wardline.operators.joins import TEST, TRAIN, splits_of
from wardline.operators.metrics import auroc_ap
from wardline.operators.ml import (
    assemble, balanced, coefficients, feature_importances, grid_search_lr, linear_probe, logspace, predict,
    project_2d, random_forest, random_search_rf, vectors,
)
from wardline.operators.sample import n_per_class, stratified_sample, weighted_sample_with_replacement
from wardline.operators.scale import apply_minmax, fit_minmax
from wardline.operators.tuples import pack_grid
from wardline.plans.grid_queries import SQL_GRID_CTE, V, events_grid_df, events_grid_table
from wardline.session import cut_lineage
from wardline.plans.registry import register, rounded
from wardline.plans.tuple_queries import SQL_PACKED, SQL_TUPLES_CTE, TIME_RANGE, events_tuples_df, packed_triplets
from wardline.sources.tables import embeddings_as_vectors, events_outcomes, labels_as_outcomes, read_table

SEED = 7


def _grid_tensor(spark, sf_dir):
    grid = events_grid_table(spark, sf_dir)
    filled = cut_lineage(ffill_and_fill(grid, grid, V.grid_vars))
    scaled = apply_minmax(filled, fit_minmax(filled, V.grid_vars))
    return pack_grid(scaled, V.grid_vars)


def _labels(spark, sf_dir):
    return labels_as_outcomes(read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"]))


def _entity_features(spark, sf_dir):
    feats = cut_lineage(stat_features(events_grid_df(spark, sf_dir), V.series_vars, V.model_static_vars))
    filled, _, _ = fill_features(feats, {})
    out = events_outcomes(read_table(spark, sf_dir, "events", columns=["user_id", "event_type", "value"]))
    return filled.join(out, "RecordID")


_GV = V.grid_vars
SQL_SCALED = f"""WITH {SQL_GRID_CTE},
  med AS (SELECT {", ".join(f'median("{v}") AS "{v}"' for v in _GV)} FROM grid),
  ff AS (SELECT RecordID, Time, {", ".join(
      f'last_value("{v}" IGNORE NULLS) OVER (PARTITION BY RecordID ORDER BY Time ROWS BETWEEN '
      f'UNBOUNDED PRECEDING AND CURRENT ROW) AS "{v}"' for v in _GV)} FROM grid),
  filled AS (SELECT RecordID, Time, {", ".join(f'coalesce(ff."{v}", med."{v}") AS "{v}"' for v in _GV)}
             FROM ff CROSS JOIN med),
  mm AS (SELECT {", ".join(f'min("{v}") AS "mn_{v}", max("{v}") AS "mx_{v}"' for v in _GV)} FROM filled),
  sc AS (SELECT RecordID, Time, {", ".join(
      f'(f."{v}" - "mn_{v}") / CASE WHEN "mx_{v}" > "mn_{v}" THEN "mx_{v}" - "mn_{v}" ELSE 1.0 END AS "{v}"'
      for v in _GV)} FROM filled f CROSS JOIN mm)"""

_SQL_TENSOR = SQL_SCALED + f""",
  tensor AS (SELECT RecordID, list([{", ".join(f'"{v}"' for v in _GV)}] ORDER BY Time) AS x FROM sc GROUP BY RecordID)"""

_MASK_HI = f"greatest(CAST(floor(len(x) * {GRID_TIME_MASK_RATIO}) AS INT), 1)"
_VIEW_KEY = "RecordID || ':' || view"
_SQL_VIEWS = _SQL_TENSOR + f""",
  v AS (SELECT RecordID, view, x, {_VIEW_KEY} AS key FROM tensor, (SELECT unnest([1, 2]) AS view)),
  m AS (SELECT *, 1 + CAST(floor({sql_uniform(SEED, "key", "11")} * {_MASK_HI}) AS INT) AS length FROM v),
  b AS (SELECT *, CAST(floor({sql_uniform(SEED, "key", "12")} * (len(x) - length + 1)) AS INT) AS start FROM m),
  views AS (SELECT RecordID, view, list_transform(x, lambda row, t: list_transform(row, lambda c, j:
      CASE WHEN t - 1 >= start AND t - 1 < start + length THEN 0.0
           ELSE c + {GRID_NOISE_STD} * {sql_normal(SEED, "key", "t - 1", "j - 1")} END)) AS x FROM b)"""


def _sql_round2(col: str) -> str:
    return f"list_transform({col}, lambda p: list_transform(p, lambda q: round(q, 6) + 0.0))"


_N = len(_GV)
_MASK_RATIO = 0.2
_SEG = 5
_SQL_MASKS = _SQL_TENSOR + f""",
  o AS (SELECT RecordID, x,
      list_transform(list_sort(list_transform(range(0, {_N}), lambda j: {{'h': {sql_uniform(SEED, "RecordID", "22", "j")}, 'j': j}}))
        [1:1 + CAST(floor({sql_uniform(SEED, "RecordID", "21")} * greatest(CAST(floor({_N} * {_MASK_RATIO}) AS INT), 1)) AS INT)],
        lambda s: s.j) AS chosen,
      list_sort(list_transform(range(0, len(x) // {_SEG}), lambda s: {{'h': {sql_uniform(SEED, "RecordID", "31", "s")}, 's': s}})) AS segs
    FROM tensor),
  p AS (SELECT RecordID, list_transform(x, lambda row: list_transform(row, lambda c, j:
          CASE WHEN list_contains(chosen, j - 1) THEN 0.0 ELSE c END)) AS a,
      list_concat(flatten(list_transform(segs, lambda o: x[o.s * {_SEG} + 1:o.s * {_SEG} + {_SEG}])),
                  x[len(x) // {_SEG} * {_SEG} + 1:len(x)]) AS b FROM o)
SELECT RecordID, {_sql_round2("a")} AS x_feature_masked, {_sql_round2("b")} AS x_permuted FROM p"""

_SQL_TRIPLET_VIEWS = SQL_PACKED + f""",
  v AS (SELECT RecordID, view, t, z, v, {_VIEW_KEY} AS key FROM packed, (SELECT unnest([1, 2]) AS view))
SELECT RecordID, view, list_transform(range(1, len(z) + 1), lambda i: {{
  't': round(t[i] + ({sql_uniform(SEED, "key", "i - 1", "1")} * 2 - 1) * {TRIPLET_TIME_SHIFT}, 6) + 0.0, 'z': z[i],
  'v': round(CASE WHEN {sql_uniform(SEED, "key", "i - 1", "3")} < {TRIPLET_DROPOUT} THEN 0.0
             ELSE v[i] + {TRIPLET_JITTER_STD} * {sql_normal(SEED, "key", "i - 1", "2")} END, 6) + 0.0}}) AS triplets
FROM v"""

BATCH = 32
_SQL_LOSS = _SQL_VIEWS + f""",
  z0 AS (SELECT RecordID, view, list_transform(range(1, {_N + 1}), lambda j: list_avg(list_transform(x, lambda row: row[j]))) AS z FROM views),
  z AS (SELECT RecordID, view, list_transform(z0.z, lambda q: q / sqrt(list_sum(list_transform(z0.z, lambda r: r * r)))) AS z FROM z0),
  batches AS (SELECT RecordID, (row_number() OVER (ORDER BY {sql_uniform(SEED, "RecordID")}, RecordID) - 1) // {BATCH} AS batch
          FROM (SELECT DISTINCT RecordID FROM z)),
  pairs AS (SELECT i.batch, i.RecordID AS a, k.RecordID AS b, list_dot_product(p.z, q.z) / 0.2 AS s
            FROM batches i JOIN batches k USING (batch) JOIN z p ON p.RecordID = i.RecordID AND p.view = 1
            JOIN z q ON q.RecordID = k.RecordID AND q.view = 2),
  r AS (SELECT batch, a AS id, ln(sum(exp(s))) - sum(s) FILTER (WHERE a = b) AS ce FROM pairs GROUP BY batch, a),
  c AS (SELECT batch, b AS id, ln(sum(exp(s))) - sum(s) FILTER (WHERE a = b) AS ce FROM pairs GROUP BY batch, b)
SELECT r.batch, count(*) AS n, round(0.5 * (avg(r.ce) + avg(c.ce)), 6) AS loss
FROM r JOIN c USING (batch, id) GROUP BY r.batch"""

_SQL_LABELS = "lab AS (SELECT doc_id AS RecordID, quality AS label FROM labels)"
_BY_HASH = f"row_number() OVER (PARTITION BY label ORDER BY {sql_uniform(SEED, 'RecordID')}, RecordID)"
_SQL_STRATIFIED = f"""WITH {_SQL_LABELS},
  c AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
  e AS (SELECT label, 100.0::DOUBLE * n / sum(n) OVER () AS exact FROM c),
  q AS (SELECT label, CAST(floor(exact) AS INT) + CASE WHEN
          row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= 100 - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM e)
SELECT RecordID, label FROM (SELECT *, {_BY_HASH} AS rk FROM lab) JOIN q USING (label) WHERE rk <= quota"""
_SQL_DRAWS = f"""WITH {_SQL_LABELS},
  c AS (SELECT label, count(*) AS n, row_number() OVER (ORDER BY label) - 1 AS ci, count(*) OVER () AS k FROM lab GROUP BY label),
  d AS (SELECT draw, CAST(floor({sql_uniform(SEED, "draw", "0")} * (SELECT max(k) FROM c)) AS INT) AS ci FROM range((SELECT count(*) FROM lab)) t(draw)),
  i AS (SELECT *, {_BY_HASH} AS idx FROM lab)
SELECT draw, c.label, i.RecordID FROM d JOIN c USING (ci)
JOIN i ON i.label = c.label AND i.idx = 1 + CAST(floor({sql_uniform(SEED, "draw", "1")} * c.n) AS BIGINT)"""


@register("n_per_class", f"""WITH {_SQL_LABELS}
SELECT RecordID, label FROM (SELECT *, {_BY_HASH} AS rk FROM lab) WHERE rk <= 10""")
def q_n_per_class(spark, sf_dir):
    """M3: ten labelled documents of each class (group limit before the shuffle)."""
    return n_per_class(_labels(spark, sf_dir), 10, seed=SEED)


@register("stratified_sample", _SQL_STRATIFIED)
def q_stratified_sample(spark, sf_dir):
    """M1: exactly 100 labelled documents, classes in proportion (largest remainder)."""
    return stratified_sample(_labels(spark, sf_dir), 100, seed=SEED)


@register("weighted_draws", _SQL_DRAWS)
def q_weighted_draws(spark, sf_dir):
    """M2: as many draws with replacement as rows, each class equally likely."""
    lab = _labels(spark, sf_dir)
    return weighted_sample_with_replacement(lab, lab.count(), seed=SEED)


@register("grid_views", f"{_SQL_VIEWS}\nSELECT RecordID, view, {_sql_round2('x')} AS x FROM views")
def q_grid_views(spark, sf_dir):
    """Y4 + Y5 + Y8: two noisy, time-masked views of each entity's scaled grid."""
    return rounded(grid_views(_grid_tensor(spark, sf_dir), seed=SEED))


_SQL_CALLER_VIEWS = _SQL_TENSOR + f""",
  v AS (SELECT RecordID, view, x, {sql_uniform(SEED, _VIEW_KEY, "41")} AS u FROM tensor, (SELECT unnest([1, 2]) AS view))
SELECT RecordID, view, list_transform(CASE WHEN u < 0.5 THEN list_reverse(x) ELSE x END,
       lambda row: list_transform(row, lambda c: round(c * (1 + u), 6) + 0.0)) AS x FROM v"""


@register("grid_caller_views", _SQL_CALLER_VIEWS)
def q_grid_caller_views(spark, sf_dir):
    """Views by a caller's function: the grid, in one half of the views
    backwards, times a factor drawn by the view."""
    def turned(x, key):
        u = hash_uniform(SEED, key, F.lit(41))
        way = F.when(u < 0.5, F.reverse(x)).otherwise(x)
        return F.transform(way, lambda row: F.transform(row, lambda c: c * (u + 1)))
    return rounded(grid_views(_grid_tensor(spark, sf_dir), augment=turned))


@register("grid_masks", _SQL_MASKS)
def q_grid_masks(spark, sf_dir):
    """Y6 + Y7: feature masking and segment permutation of each grid."""
    g = _grid_tensor(spark, sf_dir)
    key = F.col("RecordID")
    return rounded(g.select("RecordID", feature_masking("x", key, _MASK_RATIO, SEED).alias("x_feature_masked"),
                            segment_permutation("x", key, _SEG, SEED).alias("x_permuted")))


@register("triplet_views", _SQL_TRIPLET_VIEWS)
def q_triplet_views(spark, sf_dir):
    """Two jittered views of each entity's scaled and indexed (t, z, v) sequence."""
    return rounded(triplet_views(packed_triplets(spark, sf_dir), seed=SEED))


_D_ENC = 16
_SQL_TIME_ENC = (f"WITH {SQL_TUPLES_CTE}\nSELECT RecordID, Parameter, Time, list_transform(range(0, {_D_ENC}), "
                 f"lambda j: round(CASE WHEN j % 2 = 0 THEN sin((Time / {TIME_RANGE}) * exp((j - j % 2) * "
                 f"({-math.log(10000.0) / _D_ENC!r}))) ELSE cos((Time / {TIME_RANGE}) * exp((j - j % 2) * "
                 f"({-math.log(10000.0) / _D_ENC!r}))) END, 6)) AS encoding FROM tuples")


@register("tuple_time_encoding", _SQL_TIME_ENC)
def q_tuple_time_encoding(spark, sf_dir):
    """Sinusoidal encoding (width 16) of every tuple's scaled time."""
    tup = events_tuples_df(spark, sf_dir)
    return rounded(tup.select("RecordID", "Parameter", "Time",
                              time_encoding(F.col("Time") / F.lit(TIME_RANGE), _D_ENC).alias("encoding")))


def _pe_sql(t: str, j: int, d: int) -> str:
    w = f"exp({j - j % 2} * ({-math.log(10000.0) / d!r}))"
    return f"sin({t} * {w})" if j % 2 == 0 else f"cos({t} * {w})"


_SQL_POOLED = SQL_SCALED + f"""
SELECT RecordID, [{", ".join(
    f'round(avg("{v}" + {_pe_sql("CAST(Time AS DOUBLE)", j, len(_GV))}), 6)' for j, v in enumerate(_GV))}] AS pooled
FROM sc GROUP BY RecordID"""


@register("pooled_grid", _SQL_POOLED)
def q_pooled_grid(spark, sf_dir):
    """Y10 + Y12: positional encoding added to each time step, mean pooled over time."""
    g = _grid_tensor(spark, sf_dir)
    d = len(V.grid_vars)
    return rounded(g.select("RecordID", mean_over_time(add_positional_encoding("x", d)).alias("pooled")))


@register("contrastive_loss", _SQL_LOSS)
def q_contrastive_loss(spark, sf_dir):
    """Symmetric InfoNCE between the two grid views of each entity (mean pooled), per batch."""
    views = grid_views(_grid_tensor(spark, sf_dir), seed=SEED)
    z = views.select("RecordID", "view", mean_over_time("x").alias("z"))
    return rounded(info_nce(z, batch_size=BATCH, seed=SEED))


@register("rf_importances")
def q_rf_importances(spark, sf_dir):
    """M4 + M8 + O4: balanced random forest on per-entity features, importances ranked."""
    d = balanced(_entity_features(spark, sf_dir))
    cols = [c for c in d.columns if c not in ("RecordID", "label", "weight")]
    model = random_forest(n_trees=100, max_depth=10, min_leaf=4, weight_col="weight", seed=SEED).fit(assemble(d, cols))
    return rounded(feature_importances(model, cols))


def rf_random_search_report(spark, sf_dir, n_iter: int = 30, k: int = 3):
    """M5: 30 random forest settings, 3 folds, accuracy; one row per setting.
    Not registered as a driver query: 90 forest fits of up to 999 trees take
    about 12 minutes on local[8] (see README)."""
    d = _entity_features(spark, sf_dir)
    cols = [c for c in d.columns if c not in ("RecordID", "label")]
    _, scores = random_search_rf(assemble(d, cols).select("RecordID", "label", "features"),
                                 n_iter=n_iter, k=k, seed=SEED)
    rows = [(i, str(sorted(p.items())), float(a)) for i, (p, a) in enumerate(scores)]
    return rounded(spark.createDataFrame(rows, "draw int, params string, accuracy double"))


def _emb(spark, sf_dir):
    return embeddings_as_vectors(read_table(spark, sf_dir, "embeddings"))


@register("lr_cv_scores")
def q_lr_cv_scores(spark, sf_dir):
    """M6 + M7 + F15 + O5: 5-fold ROC-AUC of L2 logistic regression for C in logspace(-3, 3, 7)."""
    v = vectors(_emb(spark, sf_dir), "embedding")
    _, scores = grid_search_lr(v, logspace(), k=5, seed=SEED)
    best = max(scores, key=lambda t: t[1])[0]
    return rounded(spark.createDataFrame([(float(c), float(a), c == best) for c, a in scores],
                                         "C double, mean_auroc double, best boolean"))


@register("probe_metrics")
def q_probe_metrics(spark, sf_dir):
    """M16 + M10 + M12/M13: weighted linear probe fitted on the training split of
    the embeddings, scored by exact ROC-AUC/AP on the test split."""
    parts = splits_of(_emb(spark, sf_dir))
    model, _ = linear_probe(parts[TRAIN])
    pred = predict(model, vectors(parts[TEST], "embedding"))
    return rounded(auroc_ap(pred, "probability", "label"))


@register("coefficient_histogram")
def q_coefficient_histogram(spark, sf_dir):
    """M9 + A14: probe coefficients in 50 equal-width bins."""
    model, v = linear_probe(_emb(spark, sf_dir))
    dim = len(model.coefficients)
    coef = coefficients(model, [f"d{i}" for i in range(dim)])
    return rounded(histogram(coef, ["coefficient"], bins=50))


@register("embedding_projection")
def q_embedding_projection(spark, sf_dir):
    """Two-dimensional PCA projection of the embeddings."""
    return rounded(project_2d(_emb(spark, sf_dir)))
