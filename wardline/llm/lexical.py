"""Ranked lexical search over all documents (operator 13).

The documents are read once into an inverted index of the queried terms, cut
into segments of a few thousand documents; a segment is one row and is never
split.  A task walks its segments and keeps, for each item, the best documents
so far.  In a segment the short posting lists of an item are summed term at a
time into accumulators; the accumulators then count as one more list, bounded
by their largest sum, beside the long lists, each bounded by its largest
contribution.  Lists whose bounds together stay below the item's threshold
propose no documents; they are only looked into, by binary search, for
documents that the other lists propose and that can still reach the
threshold.  The threshold rises from segment to segment.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wardline.llm.common import small_batches, stored, text_or_empty
from wardline.llm.textops import FOLD_TABLE, word_runs

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: a segment of the index ends at so many documents or postings
SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 1 << 20
#: posting lists of a segment up to this length are summed term at a time
SHORT = 256
#: (item, term) pairs that are searched in one pass over the documents
BLOCK_PAIRS = 200_000
#: rank weights of the scoring rule: length share, scale of a posting
SHARE, SCALE = 50, 1_000_000_000


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``_item, _terms``: the distinct terms of all rows with one item id."""
    folded = F.translate(text_or_empty(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (items.select(F.col(f"`{item_col}`").alias("_item"), F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("_term"))
            .groupBy("_item").agg(F.sort_array(F.collect_set("_term")).alias("_terms")))


def index(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """One row per segment: the ids and lengths of documents with a queried
    term, the postings (document number, frequency) of each term packed as
    32-bit integers, and the documents and terms seen in all."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("docs", T.BinaryType()), T.StructField("tfs", T.BinaryType())])
    id_type = to_arrow_type(kind)
    sent = docs.sparkSession.sparkContext.broadcast([t.encode("utf-8", "surrogatepass") for t in terms])

    def build(batches):
        number = {t: i for i, t in enumerate(sent.value)}
        n_docs = n_terms = held = 0
        ids, sizes, lists = [], [], {}

        def segment() -> pa.RecordBatch:
            order = sorted(lists)
            cols = [[n_docs], [n_terms], [ids], [sizes], [order], [[len(lists[t][0]) for t in order]],
                    [b"".join(lists[t][0].tobytes() for t in order)], [b"".join(lists[t][1].tobytes() for t in order)]]
            kinds = [pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                     pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=schema.names)

        for batch in batches:
            for who, text in zip(batch.column(0), batch.column(1), strict=True):
                counts, size = Counter(), 0
                for words in word_runs(text.as_py().encode("utf-8", "surrogatepass"), FOLD_TABLE):
                    size += len(words)
                    counts.update(words)
                n_docs += size > 0
                n_terms += size
                found = [(number[w], tf) for w, tf in counts.items() if w in number]
                if found:
                    at = len(ids)
                    ids.append(who.as_py())
                    sizes.append(size)
                    held += len(found)
                    for t, tf in found:
                        if t not in lists:
                            lists[t] = (array("i"), array("i"))
                        lists[t][0].append(at)
                        lists[t][1].append(tf)
                if len(ids) >= SEGMENT_DOCS or held >= SEGMENT_POSTINGS:
                    yield segment()
                    n_docs = n_terms = held = 0
                    ids, sizes, lists = [], [], {}
        if n_docs:
            yield segment()

    rows = docs.select(F.col(f"`{id_col}`"), text_or_empty(f"`{text_col}`").alias("_text"))
    return small_batches(rows).mapInArrow(build, schema)


def best_of(entries: list[tuple], k: int) -> list[tuple]:
    """The ``k`` first of (-score, id is null, id)."""
    return sorted(entries)[:k]


def search_segment(lists: list[tuple], threshold: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of one segment that score ``threshold`` or more, and scores.

    ``lists`` holds (documents ascending, contributions) of the item's terms.
    A document may be left out only if ``k`` others of the item score more.
    """
    short = [x for x in lists if len(x[0]) <= SHORT]
    iterators = [(int(c.max()), d, c) for d, c in lists if len(d) > SHORT]
    if short:
        d, c = np.concatenate([x[0] for x in short]), np.concatenate([x[1] for x in short])
        order = np.argsort(d, kind="stable")
        d, c = d[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        sums = np.add.reduceat(c, first)
        iterators.append((int(sums.max()), d[first], sums))
        if len(sums) >= k:  # partial sums are lower bounds of k documents' scores
            threshold = max(threshold, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    iterators.sort(key=lambda x: x[0])
    upto = np.cumsum([x[0] for x in iterators])
    essential = int(np.searchsorted(upto, threshold, "left"))  # bounds of those before sum to less
    proposing = iterators[essential:]
    if not proposing:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.unique(np.concatenate([x[1] for x in proposing]))
    score = np.zeros(len(found), np.int64)
    for _, d, c in proposing:
        score[np.searchsorted(found, d)] += c
    for i in range(essential - 1, -1, -1):
        live = score + upto[i] >= threshold
        found, score = found[live], score[live]
        _, d, c = iterators[i]
        at = np.minimum(np.searchsorted(d, found), len(d) - 1)
        hit = d[at] == found
        score[hit] += c[at[hit]]
        if len(score) >= k:
            threshold = max(threshold, int(np.partition(score, len(score) - k)[len(score) - k]))
    live = score >= threshold
    return found[live], score[live]


def search_block(docs: DataFrame, rows: list, k: int, id_col: str, text_col: str, item_type, out: list[str]) -> DataFrame | None:
    """The ``k`` best documents of each task and item; None without any."""
    spark = docs.sparkSession
    terms = sorted({t for r in rows for t in r["_terms"]})
    idx = stored(index(docs, terms, id_col, text_col), "lexical-index")
    total = idx.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = total["n"], total["l"]
    if not n_docs:
        return None
    ratio = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1)
    weights = (idx.select(F.explode(F.arrays_zip("terms", "lengths")).alias("p"))
               .groupBy(F.col("p.terms").alias("term")).agg(F.sum(F.col("p.lengths").cast("long")).alias("df"))
               .select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")).collect())  # at most one row a queried term
    number = {t: i for i, t in enumerate(terms)}
    weight = dict((r["term"], r["w"]) for r in weights)
    plan = [(r["_item"], [number[t] for t in r["_terms"] if weight.get(number[t], 0) > 0]) for r in rows]
    sent = spark.sparkContext.broadcast((plan, weight, n_docs, n_terms))
    doc_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(out[0], item_type), T.StructField(out[2], doc_type), T.StructField(out[3], T.LongType())])
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]

    def search(batches):
        plan, weight, n_docs, n_terms = sent.value
        best = [[] for _ in plan]
        for batch in batches:
            for seg in batch.to_pylist():
                if not seg["ids"]:
                    continue
                ids = seg["ids"]
                m = np.array([100 - SHARE + (SHARE * n * n_docs) // n_terms for n in seg["sizes"]], np.int64)
                d, tf = np.frombuffer(seg["docs"], np.int32).astype(np.int64), np.frombuffer(seg["tfs"], np.int32).astype(np.int64)
                part = (SCALE * tf) // (1000 * tf + 20 * m[d])
                ends = np.cumsum(seg["lengths"])
                span = {t: (e - n, e) for t, n, e in zip(seg["terms"], seg["lengths"], ends, strict=True)}
                for i, (_, wanted) in enumerate(plan):
                    lists = [(d[a:b], weight[t] * part[a:b]) for t in wanted if t in span for a, b in [span[t]]]
                    if not lists:
                        continue
                    full = len(best[i]) == k
                    found, score = search_segment(lists, max(-best[i][-1][0], 1) if full else 1, k)
                    if len(found):
                        new = [(-s, ids[x] is None, 0 if ids[x] is None else ids[x]) for x, s in zip(found.tolist(), score.tolist(), strict=True)]
                        best[i] = best_of(best[i] + new, k)
        hits = [(plan[i][0], None if null else who, -s) for i, entries in enumerate(best) for s, null, who in entries]
        for at in range(0, len(hits), 10_000):
            cols = zip(*hits[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow, strict=True)], names=schema.names)

    return idx.select("ids", "sizes", "terms", "lengths", "docs", "tfs").mapInArrow(search, schema)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    Terms are runs of letters, digits and non-ASCII characters, A-Z folded.
    Equal scores rank by ascending id, null ids last.  A null text has no
    terms; each row of ``docs`` is a document of its own, also with a repeated
    id; rows of ``items`` with one id (or none) form one item; items without a
    term that occurs, empty tables and other columns give no rows.  Items are
    searched in blocks of about ``block_pairs`` distinct (item, term) pairs,
    with one pass over the documents for each.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items, item_col, item_text_col), "lexical-items")
    pairs = wanted.agg(F.sum(F.size("_terms").cast("long"))).first()[0] or 0
    n = math.ceil(pairs / block_pairs)
    doc_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    out = ["item_id", "rank", "doc_id", "score"]
    schema = T.StructType([T.StructField(out[0], item_type), T.StructField(out[2], doc_type), T.StructField(out[3], T.LongType())])
    hits = spark.createDataFrame([], schema)
    for b in range(n):
        rows = wanted.where(F.pmod(F.xxhash64("_item"), F.lit(n)) == b).collect()
        got = search_block(docs, rows, k, id_col, text_col, item_type, out) if rows else None
        if got is not None:
            hits = hits.unionByName(got) if b else got
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
