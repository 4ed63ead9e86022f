"""How the sources of a language differ in their terms (operator 12).

Texts are counted once, task by task, into a stored table of terms with their
counts per source.  What is shuffled from it are 64-bit digests of the terms,
never the terms: first to find the digests in enough documents, then to count
these per source.  The least and the largest term of each candidate digest
show whether it stands for several terms; such digests are split, and their
terms counted one by one.  Text is joined back for the rows of the report only.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import small_batches, stored, text_or_empty
from wardline.llm.textops import word_runs

#: letters and non-ASCII bytes, A-Z folded; a blank for all other bytes
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))
#: documents of a language that must hold a term
LEAST_DOCS = 30
#: smoothing of each count, and the scale of a share
PRIOR, SCALE = 5, 1_000_000_000
#: terms of a group that are listed
TOP = 50
#: counted (source, term) entries that a task holds at most before it writes them
HELD = 1_000_000
#: sources and terms of one block of the pairwise sums
BLOCK_SOURCES, BLOCK_TERMS = 256, 2048
#: bits of the map that thins the terms before a join (2 MB)
MAP_BITS = 24

COUNTED = "lang string, term string, docs long, sources array<string>, counts array<long>"


def count_terms(groups: DataFrame) -> DataFrame:
    """Terms of ``lang, source, text`` with, as far as one task has read, the
    documents of the language that hold them and the counts of each source."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()),
                        ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def rows(lang: str, docs: Counter, by_source: dict[str, Counter]):
        names = pa.array(list(by_source), pa.string())
        entries = pa.array([t for c in by_source.values() for t in c], pa.binary()).dictionary_encode()
        source = np.repeat(np.arange(len(by_source)), [len(c) for c in by_source.values()])
        n = np.fromiter((x for c in by_source.values() for x in c.values()), np.int64, len(source))
        number = entries.indices.to_numpy()
        order = np.argsort(number, kind="stable")
        ends = np.zeros(len(entries.dictionary) + 1, np.int64)
        np.cumsum(np.bincount(number, minlength=len(entries.dictionary)), out=ends[1:])
        held = np.fromiter((docs[t] for t in entries.dictionary.to_pylist()), np.int64, len(entries.dictionary))
        for at in range(0, len(held), 20_000):
            to = min(at + 20_000, len(held))
            some, offsets = order[ends[at] : ends[to]], pa.array((ends[at : to + 1] - ends[at]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (to - at), pa.string()), entries.dictionary.slice(at, to - at).cast(pa.string()), pa.array(held[at:to]),
                pa.ListArray.from_arrays(offsets, pc.take(names, pa.array(source[some]))),
                pa.ListArray.from_arrays(offsets, pa.array(n[some]))], schema=schema)

    def count(batches):
        docs: dict[str, Counter] = {}
        groups: dict[str, dict[str, Counter]] = {}

        def flush():
            for lang in groups:
                yield from rows(lang, docs[lang], groups[lang])
            docs.clear(), groups.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                lang, source = lang.as_py(), source.as_py()
                own = groups.setdefault(lang, {}).setdefault(source, Counter())
                before, seen = len(own), set()
                for words in word_runs(text.as_py().encode("utf-8", "surrogatepass"), LETTERS):
                    own.update(words)
                    seen.update(words)
                docs.setdefault(lang, Counter()).update(seen)
                held += len(own) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return small_batches(groups).mapInArrow(count, COUNTED)


def probably_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``lang, digest`` is not in ``keys``,
    and with all others: a join still has to follow, of fewer rows.

    The keys mark bits of a map of ``1 << MAP_BITS`` bits, which every task gets
    whole: its size is fixed, however many keys there are.
    """
    bit = F.xxhash64("lang", "digest").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    within = bit.bitwiseAND(F.lit(63)).cast("int")
    words = (keys.groupBy(F.shiftright(bit, 6).cast("int").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), within)).alias("bits"))).toArrow()
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def marked(at: pa.Array) -> pa.Array:
        at = at.to_numpy()
        return pa.array((sent.value[at >> 6] >> (at & 63)) & 1 == 1)

    return rows.where(marked(bit))


def kept_terms(counted: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """The terms in ``least_docs`` documents of their language or more, and
    ``counted`` with what tells them apart.

    Kept: ``lang, digest, own, sub, term``.  ``own`` is null and ``sub`` 0, or
    where terms share a digest the term itself and a number from 1; ``own`` of
    ``counted`` follows."""
    frequent = stored(counted.groupBy("lang", "digest").agg(F.sum("docs").alias("_docs")).where(F.col("_docs") >= least_docs)
                      .select("lang", "digest"), "audit-digests")
    # strings of candidate digests only
    ends = probably_in(counted, frequent).groupBy("lang", "digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
    ends = stored(ends.join(frequent, ["lang", "digest"], "left_semi"), "audit-terms")
    none = F.lit(None).cast("string").alias("own")
    clean = ends.where(F.col("lo") == F.col("hi")).select("lang", "digest", none, F.lit(0).alias("sub"), F.col("lo").alias("term"))
    shared = ends.where(F.col("lo") != F.col("hi")).select("lang", "digest")
    if shared.isEmpty():
        return clean, counted.withColumn("own", none)
    marked = (counted.join(shared.withColumn("_shared", F.lit(True)), ["lang", "digest"], "left")
              .withColumn("own", F.when(F.col("_shared"), F.col("term"))).drop("_shared"))
    apart = (marked.where(F.col("own").isNotNull()).groupBy("lang", "digest", "own").agg(F.sum("docs").alias("_docs"))
             .where(F.col("_docs") >= least_docs)
             .select("lang", "digest", "own", F.row_number().over(Window.partitionBy("lang", "digest").orderBy("own")).alias("sub"),
                     F.col("own").alias("term")))
    return stored(clean.unionByName(apart), "audit-kept"), marked


def share(count, total, terms):
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + PRIOR * terms)) + 1


def pair_sums(shares: DataFrame, groups: DataFrame, block_sources: int, block_terms: int) -> DataFrame:
    """``lang, a, b, value`` for the sources ``a < b`` of a language: the sum of
    the absolute differences of all shares.

    Sources and terms are dealt to blocks, and one task adds up one pair of
    source blocks over one block of terms.  ``shares`` lists the occurring
    terms; ``rest`` is the share of a term that the source lacks.
    """
    langs = stored(groups.groupBy("lang").agg(F.count("*").alias("_n"), F.max("terms").alias("_v")), "audit-blocks")
    dealt = (groups.join(langs, "lang").withColumn("_nb", F.ceil(F.col("_n") / block_sources).cast("int"))
             .withColumn("_ns", F.greatest(F.ceil(F.col("_v") / block_terms), F.lit(1)).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("source"), F.col("_nb")).cast("int"))
             .select("lang", "source", "rest", "terms", "_nb", "_ns", "own"))
    # every source is in every block of terms, also without a term there
    present = dealt.select("lang", "source", "rest", "terms", "_nb", "own", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1)).alias("part"),
                           F.lit(None).cast("long").alias("digest"), F.lit(None).cast("int").alias("sub"), F.lit(None).cast("long").alias("p"))
    filled = (shares.join(dealt, ["lang", "source"])
              .select("lang", "source", "rest", "terms", "_nb", "own", F.pmod(F.col("digest"), F.col("_ns")).cast("int").alias("part"),
                      "digest", "sub", "p"))
    sides = (present.unionByName(filled).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
             .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("_nb", "other"))
    out = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def block(key, rows):
        lang, left, right, part = (k.as_py() for k in key)
        here = rows.filter(pc.is_null(rows["digest"]))
        names, own = here["source"].to_pylist(), here["own"].to_numpy()
        rest, terms = here["rest"].to_numpy(), here["terms"].to_numpy()
        row = {s: i for i, s in enumerate(names)}
        filled = rows.filter(pc.is_valid(rows["digest"]))
        at = np.array([row[s] for s in filled["source"].to_pylist()], np.int64)
        term = np.stack([filled["digest"].to_numpy(), filled["sub"].to_numpy()], 1).astype(np.int64) if len(at) else np.zeros((0, 2), np.int64)
        different, column = np.unique(term, axis=0, return_inverse=True)
        p = np.repeat(rest[:, None], len(different), 1)
        p[at, column.reshape(-1)] = filled["p"].to_numpy()
        a, b, value = [], [], []
        for i in np.flatnonzero(own == left):
            js = np.flatnonzero(own == right)
            js = js[js > i] if left == right else js
            gap = np.abs(rest[js] - rest[i])
            # terms that neither has are counted once, in the first block
            sums = np.abs(p[js] - p[i]).sum(1) - len(different) * gap + (terms[i] * gap if part == 0 else 0)
            for j, x in zip(js.tolist(), sums.tolist(), strict=True):
                lo, hi = sorted((names[i], names[j]), key=lambda s: s.encode())
                a.append(lo), b.append(hi), value.append(x)
        return pa.table([[lang] * len(a), a, b, value], schema=out)

    sums = sides.groupBy("lang", "left", "right", "part").applyInArrow(block, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang: str = "lang", source: str = "source",
               text: str = "text", digest_bits: int = 64, block_sources: int = BLOCK_SOURCES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a
    language is from each other one (part ``pair``, all), and the terms that
    it has more often than its language (part ``term``, the ``top`` first).

    Null languages, sources and texts are empty strings; repeated rows count
    each; a group without terms takes part with its smoothed shares; a
    language without kept terms has pairs of value 0 and no terms; an empty
    table gives an empty result; other columns are not read.  Fewer
    ``digest_bits`` make digests collide and change nothing else.
    """
    own = docs.select(text_or_empty(f"`{lang}`").alias("lang"), text_or_empty(f"`{source}`").alias("source"),
                      text_or_empty(f"`{text}`").alias("text"))
    digest = F.xxhash64("term") if digest_bits >= 64 else F.xxhash64("term").bitwiseAND(F.lit((1 << digest_bits) - 1))
    counted = stored(count_terms(own).withColumn("digest", digest), "audit-counts")
    kept, counted = kept_terms(counted, least_docs)
    kept = stored(kept, "audit-vocabulary")
    each = F.explode(F.arrays_zip("sources", "counts")).alias("e")
    # counted per source first, so that the join has one row per source and term
    summed = (probably_in(counted, kept).select("lang", "digest", "own", each)
              .groupBy("lang", F.col("e.sources").alias("source"), "digest", "own").agg(F.sum("e.counts").alias("n"))).alias("c")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"k.{k}")) if k == "own" else F.col(f"c.{k}") == F.col(f"k.{k}") for k in ("lang", "digest", "own")]
    per_group = stored(summed.join(kept.alias("k"), same).select("c.lang", "c.source", "c.digest", "k.sub", "c.n"), "audit-groups")
    langs = stored(kept.groupBy("lang").agg(F.count("*").alias("terms")), "audit-languages")
    totals = per_group.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                    .fillna(0, ["total", "terms"]), "audit-sizes")
    with_rest = groups.withColumn("rest", F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(0))
    shares = stored(per_group.join(groups, ["lang", "source"])
                    .select("lang", "source", "digest", "sub", share(F.col("n"), F.col("total"), F.col("terms")).alias("p")), "audit-shares")

    pairs = pair_sums(shares, with_rest, block_sources, block_terms)
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e"), "value")
    pair_rows = both.select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair_rows = pair_rows.withColumn("rank", F.row_number().over(by_value))

    of_lang = per_group.groupBy("lang", "digest", "sub").agg(F.sum("n").alias("n"))
    lang_total = stored(totals.groupBy("lang").agg(F.sum("total").alias("total")).join(langs, "lang"), "audit-totals")
    q = of_lang.join(lang_total, "lang").select("lang", "digest", "sub", share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    above = (shares.join(q, ["lang", "digest", "sub"]).where(F.col("p") > F.col("q"))
             .select("lang", "source", "digest", "sub", (F.col("p") - F.col("q")).alias("value")))
    # all rows that tie with the last listed value, then their text, then the order of equal values
    first = (above.withColumn("_r", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).where(F.col("_r") <= top))
    term_rows = (first.join(kept, ["lang", "digest", "sub"])
                 .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
                 .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))
    return pair_rows.unionByName(term_rows).select("lang", "source", "part", "item", "value", F.col("rank").cast("int"))
