"""Sequence augmentation and encodings.

Random draws are hashes of (seed, entity id, view, position), so a view is
the same on any cluster layout and after a lost task is recomputed.  The
distributions equal the reference's; the individual values do not (its
draws come from global generator state).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.randomness import hash_normal, hash_uniform
from wardline.operators.sample import dense_index_by_class

# Augmentation strengths used by the reference.
GRID_NOISE_STD = 0.02
GRID_TIME_MASK_RATIO = 0.15
TRIPLET_TIME_SHIFT = 0.05
TRIPLET_JITTER_STD = 0.01
TRIPLET_DROPOUT = 0.1
SEGMENT_LEN = 5


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _randint(u: Column, lo, hi) -> Column:
    """Uniform integer in [lo, hi] from a uniform u in [0, 1)."""
    return (F.floor(u * (hi - lo + 1)) + lo).cast("int")


def view_key(id_col: str, view_col: str = "view") -> Column:
    """The random key of one view of one entity."""
    return F.concat_ws(":", F.col(id_col).cast("string"), F.col(view_col).cast("string"))


def gaussian_noise(x, key: Column, std: float = 0.05, seed: int = 0) -> Column:
    """Add N(0, std) to every cell of a time x feature array."""
    return F.transform(_col(x), lambda row, t: F.transform(
        row, lambda v, j: v + F.lit(std) * hash_normal(seed, key, t, j)))


def mask_block(n: Column, key: Column, max_ratio: float, seed: int) -> Column:
    """A block of time steps as ``(start, length)``; length uniform in
    1..floor(n * ratio), start uniform in 0..n-length."""
    hi = F.greatest(F.floor(n * F.lit(max_ratio)).cast("int"), F.lit(1))
    length = _randint(hash_uniform(seed, key, F.lit(11)), F.lit(1), hi)
    return F.struct(_randint(hash_uniform(seed, key, F.lit(12)), F.lit(0), n - length).alias("start"),
                    length.alias("length"))


def masked(x: Column, block: Column, mask_value: float = 0.0) -> Column:
    """``x`` with the time steps of ``block`` set to ``mask_value``."""
    return F.transform(x, lambda row, t: F.when(
        (t >= block["start"]) & (t < block["start"] + block["length"]),
        F.transform(row, lambda v: F.lit(mask_value))).otherwise(row))


def time_masking(x, key: Column, max_ratio: float = 0.2, seed: int = 0, mask_value: float = 0.0) -> Column:
    """One contiguous block of time steps set to ``mask_value``."""
    x = _col(x)
    return masked(x, mask_block(F.size(x), key, max_ratio, seed), mask_value)


def feature_masking(x, key: Column, max_ratio: float = 0.2, seed: int = 0, mask_value: float = 0.0) -> Column:
    """``k`` distinct feature columns (k uniform in 1..floor(F * ratio))
    set to ``mask_value``; the columns are the k smallest hash ranks."""
    x = _col(x)
    nf = F.size(F.element_at(x, 1))
    hi = F.greatest(F.floor(nf * F.lit(max_ratio)).cast("int"), F.lit(1))
    k = _randint(hash_uniform(seed, key, F.lit(21)), F.lit(1), hi)
    order = F.array_sort(F.transform(F.sequence(F.lit(0), nf - 1),
                                     lambda j: F.struct(hash_uniform(seed, key, F.lit(22), j).alias("h"), j.alias("j"))))
    chosen = F.transform(F.slice(order, 1, k), lambda s: s["j"])
    return F.transform(x, lambda row: F.transform(
        row, lambda v, j: F.when(F.array_contains(chosen, j), F.lit(mask_value)).otherwise(v)))


def segment_permutation(x, key: Column, segment_len: int = SEGMENT_LEN, seed: int = 0) -> Column:
    """Whole segments of ``segment_len`` steps in a random order; the
    remainder stays last; fewer than two segments -> unchanged."""
    x = _col(x)
    n = F.size(x)
    n_seg = F.floor(n / segment_len).cast("int")
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(n_seg - 1, F.lit(0))),
                                     lambda s: F.struct(hash_uniform(seed, key, F.lit(31), s).alias("h"),
                                                        s.alias("s"))))
    segs = F.transform(order, lambda o: F.slice(x, o["s"] * segment_len + 1, segment_len))
    rest = F.slice(x, n_seg * segment_len + 1, F.greatest(n - n_seg * segment_len, F.lit(0)))
    permuted = F.concat(F.flatten(segs), rest)
    return F.when(n_seg < 2, x).otherwise(permuted)


def grid_views(df: DataFrame, x_col: str = "x", id_col: str = "RecordID", seed: int = 0,
               noise_std: float = GRID_NOISE_STD, mask_ratio: float = GRID_TIME_MASK_RATIO, augment=None) -> DataFrame:
    """Two independent views per entity: noise then time masking, or
    what ``augment(x, key)`` makes of the grid; the key differs by view."""
    v = df.select(F.col(id_col), F.col(x_col), F.explode(F.array(F.lit(1), F.lit(2))).alias("view"))
    key = view_key(id_col)
    if augment is not None:
        return v.select(id_col, "view", augment(F.col(x_col), key).alias(x_col))
    # the block is a column of its own, so that it is drawn once a view, not once a time step
    v = v.withColumn("_block", mask_block(F.size(x_col), key, mask_ratio, seed))
    v = v.withColumn("_noisy", gaussian_noise(x_col, key, noise_std, seed))
    return v.select(id_col, "view", masked(F.col("_noisy"), F.col("_block")).alias(x_col))


def augment_triplets(triplets, key: Column, seed: int = 0, time_shift: float = TRIPLET_TIME_SHIFT,
                     jitter_std: float = TRIPLET_JITTER_STD, dropout: float = TRIPLET_DROPOUT) -> Column:
    """Per triplet t + U(-shift, shift), v + N(0, jitter), and v -> 0 with
    probability ``dropout``; z unchanged."""
    return F.transform(_col(triplets), lambda s, i: F.struct(
        (s["t"] + (hash_uniform(seed, key, i, F.lit(1)) * 2 - 1) * F.lit(time_shift)).alias("t"),
        s["z"].alias("z"),
        F.when(hash_uniform(seed, key, i, F.lit(3)) < F.lit(dropout), F.lit(0.0))
         .otherwise(s["v"] + F.lit(jitter_std) * hash_normal(seed, key, i, F.lit(2))).alias("v")))


def triplet_views(df: DataFrame, col: str = "triplets", id_col: str = "RecordID", seed: int = 0) -> DataFrame:
    """Y9 in the contrastive layout: two augmented views per entity."""
    v = df.select(F.col(id_col), F.col(col), F.explode(F.array(F.lit(1), F.lit(2))).alias("view"))
    key = view_key(id_col)
    return v.select(id_col, "view", augment_triplets(col, key, seed).alias(col))


def sinusoid(pos: Column, d_model: int) -> Column:
    """``[sin(p w_0), cos(p w_0), sin(p w_1), ...]`` with
    ``w_i = exp(-2i ln(10000) / d)``; ``pos`` may be an index or a scaled time."""
    return F.transform(F.sequence(F.lit(0), F.lit(d_model - 1)), lambda j: F.when(
        j % 2 == 0, F.sin(pos * F.exp((j - j % 2) * F.lit(-math.log(10000.0) / d_model))))
        .otherwise(F.cos(pos * F.exp((j - j % 2) * F.lit(-math.log(10000.0) / d_model)))))


def add_positional_encoding(x, d_model: int) -> Column:
    """Add the sinusoidal encoding of the row index (width ``d_model``,
    the feature count) to each time step."""
    return F.transform(_col(x), lambda row, t: F.zip_with(
        row, sinusoid(t.cast("double"), d_model), lambda a, b: a + b))


def time_encoding(t_col, d_model: int) -> Column:
    """Encoding of a continuous (scaled) time value."""
    return sinusoid(_col(t_col).cast("double"), d_model)


def mean_pool(x) -> Column:
    """Mean over the inner arrays (time x dim -> time)."""
    return F.transform(_col(x), lambda row: F.aggregate(row, F.lit(0.0), lambda a, v: a + v) / F.size(row))


def mean_over_time(x) -> Column:
    """Mean over the outer axis (time x dim -> dim)."""
    x = _col(x)
    return F.transform(F.sequence(F.lit(0), F.size(F.element_at(x, 1)) - 1), lambda j: F.aggregate(
        x, F.lit(0.0), lambda a, row: a + F.get(row, j)) / F.size(x))


def _info_nce_batch(temperature: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["RecordID", "view"])
        ids = pdf["RecordID"].unique()
        z1 = np.stack(pdf[pdf["view"] == 1]["z"].to_numpy())
        z2 = np.stack(pdf[pdf["view"] == 2]["z"].to_numpy())
        z1 = z1 / np.linalg.norm(z1, axis=1, keepdims=True)
        z2 = z2 / np.linalg.norm(z2, axis=1, keepdims=True)
        logits = z1 @ z2.T / temperature
        idx = np.arange(len(ids))

        def ce(m):
            mx = m.max(axis=1, keepdims=True)
            lse = (mx + np.log(np.exp(m - mx).sum(axis=1, keepdims=True)))[:, 0]
            return float(np.mean(lse - m[idx, idx]))
        loss = 0.5 * (ce(logits) + ce(logits.T))
        return pd.DataFrame({"batch": [int(pdf["batch"].iloc[0])], "n": [len(ids)], "loss": [loss]})
    return run


def info_nce(views: DataFrame, z_col: str = "z", id_col: str = "RecordID", batch_size: int = 64,
             temperature: float = 0.2, seed: int = 0) -> DataFrame:
    """Symmetric InfoNCE of two views per entity within batches.

    Entities get a dense index in hash order; every ``batch_size`` of them
    form a batch (only the last may hold fewer), so work per group is bounded
    by the batch, never by the table.  Returns ``(batch, n, loss)``.
    """
    ids = views.select(F.col(id_col).alias("RecordID"), F.lit(0).alias("_all")).distinct()
    batch = dense_index_by_class(ids, "_all", "RecordID", seed).select(
        "RecordID", F.floor((F.col("_idx") - 1) / F.lit(batch_size)).cast("long").alias("batch"))
    b = (views.select(F.col(id_col).alias("RecordID"), "view", F.col(z_col).cast("array<double>").alias("z"))
         .join(batch, "RecordID"))
    return b.groupBy("batch").applyInPandas(_info_nce_batch(temperature), "batch long, n long, loss double")
