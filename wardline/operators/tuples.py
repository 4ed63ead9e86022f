"""Event-tuple layout and sequence packing.

Packing is the one place where rows of an entity are gathered into one
value.  The packed sequence holds at most ``max_len`` items (the earliest),
which is all a sequence model ever reads (the loaders truncate there).  The
top ``max_len`` per entity is taken with ``row_number() <= max_len``, which
Spark plans as a group limit *before* the shuffle, so even an entity that
holds a third of all rows sends at most ``max_len`` rows per input
partition to the task that packs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.functions.timefmt import elapsed_minutes
from wardline.operators.common import broadcast_if_bounded
from wardline.operators.quality import apply_long_rules
from wardline.session import cut_lineage
from wardline.vocab import ICU, ICU_MAX_SEQ_LEN, ICU_PAD_INDEX, Vocabulary

PAD_VALUE = -999.0


def event_tuples(dedup: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
                 param_col: str = "Parameter", time_col: str = "Time",
                 value_col: str = "Value") -> DataFrame:
    """P7 + F1 + P8 + F17: deduplicated records (time as ``'HH:MM'`` or whole
    minutes) -> ``(id LONG, Parameter,
    Time INT minutes, Value)`` with implausible values, identifiers and
    categories removed (they become null and null rows are dropped)."""
    cleaned = apply_long_rules(dedup, vocab, param_col, value_col)
    return (cleaned
            .select(F.col(id_col).cast("long").alias(id_col), F.col(param_col),
                    elapsed_minutes(dedup, time_col).alias(time_col), F.col(value_col))
            .where(F.col(value_col).isNotNull()))


def sort_tuples(df: DataFrame, id_col: str = "RecordID", time_col: str = "Time",
                param_col: str = "Parameter") -> DataFrame:
    """O1: total order (id, time, parameter); a range-partitioned sort."""
    return df.orderBy(id_col, time_col, param_col)


def sequence_lengths(df: DataFrame, id_col: str = "RecordID") -> DataFrame:
    """Number of tuples per entity (input of A18), an aggregate, not a pack."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("length"))


def fit_modality_map(train: DataFrame, param_col: str = "Parameter", id_col: str = "RecordID",
                     time_col: str = "Time", pad_index: int = ICU_PAD_INDEX) -> DataFrame:
    """Parameter -> index 1, 2, ... in order of first appearance in the
    training table sorted by (id, time, parameter); index ``pad_index`` is
    ``<PAD>``.  The global window runs over one row per parameter."""
    first = (train.groupBy(param_col)
             .agg(F.min(F.struct(F.col(id_col), F.col(time_col), F.col(param_col))).alias("_first")))
    ranked = first.select(F.col(param_col),
                          (F.row_number().over(Window.orderBy("_first")) + F.lit(pad_index)).alias("z"))
    pad = train.sparkSession.createDataFrame([("<PAD>", pad_index)], f"{param_col} string, z int")
    return ranked.unionByName(pad)


def vocabulary_size(modality_map: DataFrame, configured: int | None = None) -> int:
    """Max index + 1 (a single number).  A ``configured`` size that does
    not hold every index raises."""
    size = modality_map.agg(F.max("z")).first()[0] + 1
    if configured is not None and size > configured:
        raise ValueError(f"the map needs {size} indices, {configured} are configured")
    return size


def apply_modality_map(df: DataFrame, modality_map: DataFrame, param_col: str = "Parameter",
                       out_col: str = "z") -> DataFrame:
    """Parameter -> index, unmapped parameters get null.  The map has one
    row per parameter seen in training; it is broadcast after a size check."""
    return df.join(broadcast_if_bounded(modality_map.select(param_col, F.col("z").alias(out_col))),
                   param_col, "left")


def pack_triplets(df: DataFrame, id_col: str = "RecordID", time_col: str = "Time",
                  param_col: str = "Parameter", z_col: str = "z", value_col: str = "Value",
                  max_len: int = ICU_MAX_SEQ_LEN, order_time_col: str | None = None) -> DataFrame:
    """A6 + Y1: per entity the first ``max_len`` triplets ``(t, z, v)`` in
    (time, parameter) order, as ``ARRAY<STRUCT<t, z, v>>``.  ``order_time_col``
    orders when ``time_col`` holds an already scaled time."""
    w = Window.partitionBy(id_col).orderBy(order_time_col or time_col, param_col)
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_len)
    packed = (top.groupBy(id_col)
              .agg(F.array_sort(F.collect_list(F.struct(
                  F.col("_rn"), F.col(time_col).cast("double").alias("t"),
                  F.col(z_col).cast("int").alias("z"), F.col(value_col).cast("double").alias("v"))))
                   .alias("_s")))
    return packed.select(id_col, F.transform("_s", lambda x: F.struct(x["t"].alias("t"), x["z"].alias("z"),
                                                                        x["v"].alias("v"))).alias("triplets"))


def pack_chunks(df: DataFrame, id_col: str = "RecordID", time_col: str = "Time", param_col: str = "Parameter", z_col: str = "z",
                value_col: str = "Value", chunk: int = 512, order_time_col: str | None = None, n_ranges: int | None = None) -> DataFrame:
    """A6 uncut: all triplets of every entity in (time, parameter) order, as
    ``(id, chunk, triplets)`` with at most ``chunk`` triplets a row; chunks
    count from 0, and their arrays joined are the whole sequence.

    A row's place in its entity is its place in a range of the sorted rows
    plus the entity's rows in the ranges before, so an entity of any size is
    spread over many tasks and no array holds more than ``chunk`` triplets.
    """
    order = [id_col, order_time_col or time_col, param_col]
    n = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(df.repartitionByRange(n, *order).withColumn("_r", F.spark_partition_id()))  # keep the sampled ranges
    sizes = dealt.groupBy(id_col, "_r").agg(F.count("*").alias("_n"))  # one row per entity and range
    before = Window.partitionBy(id_col).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(id_col).alias("_id"), F.col("_r").alias("_or"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(id_col, "_r").orderBy(*order[1:])
    placed = dealt.withColumn("_rn", F.row_number().over(within))
    placed = (placed.join(offsets, placed[id_col].eqNullSafe(offsets["_id"]) & (placed["_r"] == offsets["_or"]))
              .withColumn("_rn", F.col("_rn") + F.col("_before") - 1))
    return (placed.groupBy(id_col, F.floor(F.col("_rn") / chunk).cast("long").alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct(
                F.col("_rn"), F.col(time_col).cast("double").alias("t"), F.col(z_col).cast("int").alias("z"),
                F.col(value_col).cast("double").alias("v")))).alias("_s"))
            .select(id_col, "chunk", F.transform("_s", lambda x: F.struct(x["t"].alias("t"), x["z"].alias("z"), x["v"].alias("v"))).alias("triplets")))


def split_triplets(df: DataFrame, col: str = "triplets") -> DataFrame:
    """Y2: array of triplets -> three arrays t, z, v."""
    return (df.withColumn("t", F.transform(col, lambda x: x["t"]))
            .withColumn("z", F.transform(col, lambda x: x["z"]))
            .withColumn("v", F.transform(col, lambda x: x["v"]))
            .drop(col))


def pad_sequences(df: DataFrame, length: int | None = None, pad_value: float = PAD_VALUE,
                  pad_index: int = ICU_PAD_INDEX) -> DataFrame:
    """Pad t, v with ``pad_value`` and z with ``pad_index`` to ``length``
    (default: the longest sequence, one aggregate) and add ``mask = (z == pad)``."""
    if length is None:
        length = df.agg(F.max(F.size("z"))).first()[0] or 0
    n = F.lit(int(length))

    def pad(c, v):
        return F.concat(F.col(c), F.array_repeat(v, F.greatest(n - F.size(c), F.lit(0))))

    return (df.withColumn("t", pad("t", F.lit(float(pad_value))))
            .withColumn("v", pad("v", F.lit(float(pad_value))))
            .withColumn("z", pad("z", F.lit(int(pad_index))))
            .withColumn("mask", F.transform("z", lambda x: x == F.lit(int(pad_index)))))


def last_step(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Last element of a sequence column."""
    return df.withColumn(out_col or f"{col}_last", F.element_at(col, -1))


def pack_grid(grid: DataFrame, columns, id_col: str = "RecordID", time_col: str = "Time",
              with_time: bool = False) -> DataFrame:
    """A4: grid rows -> per entity ``ARRAY<ARRAY<DOUBLE>>`` (time x features)
    in time order; ``with_time`` appends the time as the last feature.
    Groups are one grid (n_bins rows), so the pack is bounded."""
    feats = [F.col(f"`{c}`").cast("double") for c in columns]
    if with_time:
        feats.append(F.col(time_col).cast("double"))
    return (grid.groupBy(id_col)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(time_col).alias("_t"),
                                                      F.array(*feats).alias("_x")))).alias("_s"))
            .select(id_col, F.transform("_s", lambda s: s["_x"]).alias("x")))
