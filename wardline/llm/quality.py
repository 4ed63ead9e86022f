"""Quality rules with adaptive thresholds (operator 10, built-in functions only).

Every text is measured once.  A quantile sketch of each measure is kept per
language and source: counts of logarithmic buckets, which merge by addition
and give each quantile within a fixed relative error, whatever the order of
the rows.  A row fails a rule if its measure lies beyond the fence of its own
group; the verdicts come from one join of the measures with the thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import same_key, stored, text_or_empty

#: words of ``[^\x20\x09-\x0D]+`` and symbols, as patterns
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

#: buckets grow by this factor, so quantiles are right within about 2.5 percent
GROWTH = 1.05
#: a group's fence counts like this many rows of the next wider group's fence
PRIOR_ROWS = 20
#: a fence is ``median + SPREAD * (median - lower quartile) + slack``: of two
#: quantiles that even a dirty third of a group does not move
LOWER, SPREAD = 0.25, 4.0
#: measure -> (slack, highest limit); the slack is what a group without any
#: spread may still deviate, and a share cannot exceed 1
RULES = {"symbol_ratio": (0.05, 1.0), "dup_line_ratio": (0.4, 1.0), "repeat_ratio": (0.2, 1.0), "word_length": (1.5, 1e9)}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(hashes: Column, k: int = 8) -> Column:
    """Words inside ``k``-word windows that occur twice or more, from the array
    of word hashes.  Windows are compared by 64-bit hash; only texts with a
    repeat sort their windows."""
    def rolling(h: Column) -> Column:
        # hashes of 2, 4 and 8 words: each level joins two of the level below
        pair = lambda a, d: F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - d, F.lit(0))),
                                       F.slice(a, d + 1, F.greatest(F.size(a) - d, F.lit(0))), lambda x, y: F.xxhash64(x, y))
        return let(h, lambda a: let(pair(a, 1), lambda b: let(pair(b, 2), lambda c: pair(c, 4))))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        neighbours = lambda s: F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        at = F.sort_array(F.array_distinct(F.flatten(F.array_compact(let(placed, neighbours)))))
        gaps = lambda p: F.aggregate(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                                                lambda a, b: F.least(b - a, F.lit(k))), F.lit(k), lambda n, g: n + g)
        return let(at, gaps)

    return F.when(F.size(hashes) <= k, F.lit(0)).otherwise(let(rolling(hashes), lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the measures of the text."""
    keep = [c for c in docs.columns if c != text_col]
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    lines = F.filter(F.split(F.col("_t"), "\n"), has_word)
    df = docs.withColumn("_t", text_or_empty(text_col)).select(
        *keep, F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"),
        F.regexp_count("_t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).alias("_lines"))
    return df.select(*keep, F.size("_w").cast("long").alias("n_words"),
                     F.length(F.array_join("_w", "")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
                     repeated_words(F.transform("_w", lambda x: F.xxhash64(x))).cast("long").alias("n_repeat_words"), "_lines")


def ratios(df: DataFrame) -> DataFrame:
    """The measures that the rules compare; without words all are 0."""
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return (df.withColumn("symbol_ratio", part("n_symbols", "word_chars")).withColumn("dup_line_ratio", part("n_dup_lines", "_lines"))
            .withColumn("repeat_ratio", part("n_repeat_words", "n_words")).withColumn("word_length", part("word_chars", "n_words")))


def sketch(df: DataFrame, keys: list[str], measure_cols: list[str]) -> DataFrame:
    """Mergeable sketch: rows per key, measure and logarithmic bucket."""
    bucket = lambda c: F.when(F.col(c) <= 1e-6, F.lit(-1000)).otherwise(
        F.ceil(F.log(F.col(c)) / F.log(F.lit(GROWTH)))).cast("int")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), bucket(c).alias("bucket")) for c in measure_cols])).alias("m")
    return df.select(*keys, each).groupBy(*keys, "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def merged(sk: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch of coarser keys."""
    return sk.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sk: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Quantiles of each key and measure: the upper edge of the bucket with the
    row of that rank.  A key has at most a few hundred buckets."""
    from pyspark.sql import Window

    own = Window.partitionBy(*keys, "measure")
    run = sk.withColumn("upto", F.sum("n").over(own.orderBy("bucket"))).withColumn("rows", F.sum("n").over(own))
    edge = F.when(F.col("bucket") == -1000, F.lit(0.0)).otherwise(F.pow(F.lit(GROWTH), F.col("bucket")))
    return run.groupBy(*keys, "measure").agg(F.first("rows").alias("rows"), *[
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("rows")), edge)).alias(name) for name, q in qs.items()])


def thresholds(df: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source`` and one threshold per rule, from the sketches."""
    fine = stored(sketch(df.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *RULES), ["lang", "source"], list(RULES)), "sketch")
    qs = {"low": LOWER, "mid": 0.5}
    by_group = sketch_quantiles(fine, ["lang", "source"], qs)
    by_lang = sketch_quantiles(merged(fine, ["lang"]), ["lang"], qs)
    overall = sketch_quantiles(merged(fine, []), [], qs)
    of_rule = lambda i: F.create_map(*[F.lit(x) for k, v in RULES.items() for x in (k, v[i])])
    fence = lambda d: F.least(d["mid"] + F.lit(SPREAD) * (d["mid"] - d["low"]) + of_rule(0)[d["measure"]], of_rule(1)[d["measure"]])
    shrunk = lambda rows, own, wide: (rows * own + F.lit(float(PRIOR_ROWS)) * wide) / (rows + F.lit(float(PRIOR_ROWS)))
    lang_fence = by_lang.select(F.col("lang").alias("_l"), F.col("measure").alias("_lm"), F.col("rows").alias("_ln"), fence(by_lang).alias("_lf"))
    all_fence = overall.select(F.col("measure").alias("_am"), fence(overall).alias("_af"))
    own = by_group.withColumn("_f", fence(by_group))
    full = (own.join(lang_fence, own["lang"].eqNullSafe(lang_fence["_l"]) & (own["measure"] == lang_fence["_lm"]))
            .join(all_fence, F.col("measure") == F.col("_am")))
    limit = shrunk(F.col("rows"), F.col("_f"), shrunk(F.col("_ln"), F.col("_lf"), F.col("_af")))
    return (full.select("lang", "source", "measure", limit.alias("limit"))
            .groupBy("lang", "source").pivot("measure", list(RULES)).agg(F.max("limit")))


def quality_report(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Measures and verdict of each row.

    ``base_failed``: fewer than 20 words, or more than 30 percent of the words
    in repeated 8-word windows.  Otherwise a row is kept unless a measure lies
    above its group's threshold, which is shrunk towards its language's and the
    corpus' by row counts and may be stricter or looser than theirs.  A null text is empty and fails; null
    languages and sources form groups of their own; repeated rows count each;
    an empty table gives an empty result.
    """
    m = stored(ratios(measures(docs.select(F.col(id_col), F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col("text")))), "measures")
    limits = stored(thresholds(m, "_lang", "_source"), "thresholds")
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *[F.col(c).alias(f"_max_{c}") for c in RULES])
    joined = m.join(limits, same_key(m, limits, [("_lang", "_l"), ("_source", "_s")]), "left")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    inside = F.lit(True)
    for c in RULES:
        inside = inside & F.coalesce(F.col(c) <= F.col(f"_max_{c}"), F.lit(True))
    return joined.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & inside).alias("kept"))
