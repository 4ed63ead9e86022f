"""Long events -> regular time grid.

Shuffle plan of :func:`time_grid` at scale:

1. ``aggregate_duplicates`` groups by the full key (id, parameter, minute as an
   integer) of the rows inside the grid, so a hot entity is spread over many tasks.
2. binning + hourly aggregation groups by (id, bin) with map-side partial
   aggregation, so what is shuffled is at most one row per (id, bin) per
   input partition.
3. densify + static propagation groups by id only, over at most ``n_bins``
   rows per id (bounded), and leaves the grid hash-partitioned by id so the
   forward fill (window by id) and per-entity features (group by id) that
   follow need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.timefmt import elapsed_minutes, minutes_to_bin
from wardline.operators.quality import apply_wide_rules
from wardline.vocab import ICU, ICU_N_BINS, Vocabulary


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def aggregate_duplicates(df: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
                         param_col: str = "Parameter", time_col: str = "Time",
                         value_col: str = "Value", strict: bool = True) -> DataFrame:
    """A1: one value per (id, parameter, time).

    Group size counts rows with a missing value too; sum / max / mean skip
    missing values; rows with a missing key are dropped.  One value -> kept;
    two -> summed (``sum_params``), max (``max_params``) or mean; three or
    more -> summed, mean (``mean_many_params``) or, for any other parameter,
    an error when ``strict`` (the two-value rule otherwise).  A sum over
    only missing values is 0.
    """
    p = F.col(param_col)
    g = (df.where(F.col(id_col).isNotNull() & p.isNotNull() & F.col(time_col).isNotNull())
         .groupBy(id_col, param_col, time_col)
         .agg(F.count(F.lit(1)).alias("_n"),
              F.sum(value_col).alias("_sum"),
              F.max(value_col).alias("_max"),
              F.avg(value_col).alias("_mean")))
    n = F.col("_n")
    summed = F.coalesce(F.col("_sum"), F.lit(0.0))
    is_sum = p.isin(*vocab.sum_params) if vocab.sum_params else F.lit(False)
    is_max = p.isin(*vocab.max_params) if vocab.max_params else F.lit(False)
    is_many = p.isin(*vocab.mean_many_params) if vocab.mean_many_params else F.lit(False)
    two_rule = F.when(is_sum, summed).when(is_max, F.col("_max")).otherwise(F.col("_mean"))
    many_rule = F.when(is_sum, summed).when(is_many, F.col("_mean"))
    if strict:
        many_rule = many_rule.otherwise(F.raise_error(F.concat(
            F.lit("More than 2 values for the same key: "),
            F.col(id_col).cast("string"), F.lit(" "), p, F.lit(" "),
            F.col(time_col).cast("string"))).cast("double"))
    else:
        many_rule = many_rule.otherwise(two_rule)
    value = F.when(n == 1, F.col("_mean")).when(n == 2, two_rule).otherwise(many_rule)
    return g.select(id_col, param_col, time_col, value.alias(value_col))


def pivot_records(df: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
                  param_col: str = "Parameter", time_col: str = "Time",
                  value_col: str = "Value") -> DataFrame:
    """A2 + P4: long -> wide on (id, time) with the explicit parameter list
    (no discovery job), the id parameter dropped, static copies added.

    Input must be free of duplicates (run :func:`aggregate_duplicates`).
    """
    params = vocab.raw_params
    wide = (df.groupBy(id_col, time_col)
            .pivot(param_col, params)
            .agg(F.first(value_col)))
    for src, dst in vocab.static_copies.items():
        wide = wide.withColumn(dst, _q(src))
    return wide.select(id_col, time_col, *[_q(v) for v in vocab.grid_vars])


def bin_records(df: DataFrame, time_col: str = "Time", bin_minutes: int = 60,
                out_col: str = "Time") -> DataFrame:
    """F1 + F2: ``'HH:MM'`` or whole minutes -> ceiling bin index (hour by default)."""
    return df.withColumn(out_col, minutes_to_bin(elapsed_minutes(df, time_col), bin_minutes))


def grid_minutes(bin_minutes: int, n_bins: int) -> tuple[int, int]:
    """First and last minute whose ceiling bin lies in ``0..n_bins-1``."""
    return 1 - bin_minutes, (n_bins - 1) * bin_minutes


def records_in_grid(records: DataFrame, time_col: str = "Time", bin_minutes: int = 60,
                    n_bins: int = ICU_N_BINS) -> DataFrame:
    """records with ``time_col`` in integer minutes, those inside the grid
    only.  Missing times are left out; text that is no ``HH:MM`` ends the job."""
    return (records.withColumn(time_col, elapsed_minutes(records, time_col))
            .where(F.col(f"`{time_col}`").between(*grid_minutes(bin_minutes, n_bins))))


def binned_means(df: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
                 param_col: str = "Parameter", time_col: str = "Time",
                 value_col: str = "Value", bin_minutes: int = 60,
                 n_bins: int = ICU_N_BINS) -> DataFrame:
    """A3 (sparse part): one row per (id, bin) that has any record row.

    Mean of the deduplicated values per variable, except ``hourly_sum_params``
    which sum, and sum to 0 in a bin that has rows but no value of that
    variable (Q-1).  Static copies take the mean of their source.  Bins
    outside ``0..n_bins-1`` are dropped before the shuffle.

    This fuses pivot (A2) and the hourly mean: the mean over pivoted rows of
    a bin equals the mean over its long rows, and a bin has a pivoted row iff
    it has a long row.
    """
    b = minutes_to_bin(elapsed_minutes(df, time_col), bin_minutes)
    src = (df.select(F.col(id_col), F.col(param_col), b.alias("_bin"), F.col(value_col))
           .where(F.col("_bin").between(0, n_bins - 1)))
    aggs = []
    for v in vocab.raw_params:
        val = F.when(F.col(param_col) == v, F.col(value_col))
        if v in vocab.hourly_sum_params:
            aggs.append(F.coalesce(F.sum(val), F.lit(0.0)).alias(v))
        else:
            aggs.append(F.avg(val).alias(v))
    out = src.groupBy(F.col(id_col), F.col("_bin").alias(time_col)).agg(*aggs)
    for s, dst in vocab.static_copies.items():
        out = out.withColumn(dst, _q(s))
    return out


def densify_and_propagate(sparse: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
                          time_col: str = "Time", n_bins: int = ICU_N_BINS) -> DataFrame:
    """J6 + W3: every id gets all ``n_bins`` rows (missing bins all null);
    each static takes its first non-null value in time order on every row.

    One shuffle by id, over at most ``n_bins`` rows per id (bounded): the
    dense rows come from ``sequence(0, n_bins-1)`` looked up in a per-id bin
    map, so there is no cross join with a skeleton and no join back.
    """
    value_vars = vocab.grid_vars
    row = F.struct(*[_q(v) for v in value_vars])
    per_id = (sparse.groupBy(id_col)
              .agg(F.map_from_entries(F.collect_list(F.struct(F.col(time_col), row))).alias("_m")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)),
                        lambda t: F.struct(t.alias(time_col), F.try_element_at(F.col("_m"), t).alias("_r")))
    statics = []
    for s in vocab.static_vars:
        # first non-null static value in bin order, once per id (before the rows are generated)
        firsts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)),
                                      lambda t: F.try_element_at(F.col("_m"), t)[s]),
                          lambda x: x.isNotNull())
        statics.append(F.try_element_at(firsts, F.lit(1)).alias(f"_s_{s}"))
    exploded = (per_id.select(F.col(id_col), F.col("_m"), *statics)
                .select(F.col(id_col), *[F.col(f"`_s_{s}`") for s in vocab.static_vars], F.inline(dense)))
    cols = [F.col(id_col), F.col(time_col)]
    for v in value_vars:
        src = F.col(f"`_s_{v}`") if v in vocab.static_vars else F.col("_r")[v]
        cols.append(src.cast("double").alias(v))
    return exploded.select(*cols)


def time_grid(records: DataFrame, vocab: Vocabulary = ICU, id_col: str = "RecordID",
              param_col: str = "Parameter", time_col: str = "Time", value_col: str = "Value",
              bin_minutes: int = 60, n_bins: int = ICU_N_BINS, strict: bool = True,
              clean: bool = True) -> DataFrame:
    """Long records -> ``(id, Time 0..n_bins-1, statics, series)`` grid.

    minutes (F1) -> dedup (A1) -> bin (F2) -> binned means (A2 + A3) -> densify (J6) ->
    static propagation (W3) -> plausibility (P5, P6; after propagation,
    so an implausible first static stays null, Q-3).
    """
    inside = records_in_grid(records, time_col, bin_minutes, n_bins)
    dedup = aggregate_duplicates(inside, vocab, id_col, param_col, time_col, value_col, strict)
    sparse = binned_means(dedup, vocab, id_col, param_col, time_col, value_col, bin_minutes, n_bins)
    grid = densify_and_propagate(sparse, vocab, id_col, time_col, n_bins)
    if clean:
        grid = apply_wide_rules(grid, vocab)
    return grid
