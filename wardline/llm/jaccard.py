"""N-gram Jaccard join by banded MinHash (operator 5).

1. Equal word sequences are one *text* (its row of least id stands for it).
   Texts are numbered in the order of that id and, where ids are equal or null,
   of a digest of the words, so that different texts never share a number.
2. Each text gets ``bands * rows`` minimum hashes of its set of word n-grams;
   the values of a band are hashed to one key.  The least number among the texts
   of a key is its *hub*; hubs found in another hub's bucket point to it.
3. Texts that share a key share a hub, so each hub's members are compared on
   their full n-gram sets.  Large groups are dealt into pairs of blocks; a
   block pair is one task and counts links by matrix products over distinct
   membership patterns of n-grams, so no list of pairs is ever written.  A pair that meets under
   several hubs counts under the least.
4. Each block pair also returns a spanning forest of its links; classes are the
   connected components over all forests.

Band and row counts are chosen from the similarity and the recall wanted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import fresh, small_batches, stored, text_or_empty
from wardline.llm.textops import FOLD, FOLDED_WORDS, find_words, hash_words, join_texts, mix, slices, windows

#: texts in a block, and n-grams in a block, about
BLOCK_TEXTS, BLOCK_GRAMS = 1024, 1 << 20


def banding(similarity: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """Bands (and rows) with which a pair at ``similarity`` is found with
    probability ``recall``; more similar pairs are found more surely."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)), rows


def grams(texts: list[bytes], n: int):
    """Sorted distinct n-gram hashes of each text and a digest of its words.

    A text of fewer than ``n`` words but at least one has one gram: all of it."""
    buf, at = join_texts(texts)
    buf = FOLD[buf]
    starts, ends = find_words(buf, FOLDED_WORDS)
    h = hash_words(buf, starts, ends, 5)
    g = windows(h, n)
    first = np.searchsorted(starts, at)
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if a == b:
            yield np.zeros(0, np.uint64), b""
            continue
        k = b - a
        own = np.sort(g[a : b - n + 1]) if k >= n else mix(np.array([np.bitwise_xor.reduce(mix(h[a:b] + np.arange(k, dtype=np.uint64)))]))
        if len(own) > 1:
            own = own[np.append(True, own[1:] != own[:-1])]
        w = h[a:b] * (np.arange(k, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        yield own, np.array([mix(w).sum(), np.bitwise_xor.reduce(mix(w ^ np.uint64(k)))], np.uint64).tobytes()


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band keys (texts x bands) of non-empty sets."""
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets])[:-1]
    low = np.empty((len(sets), bands * rows), np.uint64)
    for j in range(bands * rows):
        x = (flat ^ add[j]) * odd[j]
        x ^= x >> np.uint64(32)
        low[:, j] = np.minimum.reduceat(x * odd[j - 1], at)
    key = np.zeros((len(sets), bands), np.uint64)
    for r in range(rows):
        key = mix(key + low[:, r::rows] + np.uint64(r + 1))
    return mix(key + np.arange(bands, dtype=np.uint64))


def describe(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``_id, _raw, _digest, _grams (count), _keys`` of each row of ``_id, _text``;
    ``_raw`` is a hash of the text as it is."""

    @F.arrow_udf("struct<_digest:binary,_grams:int,_keys:array<long>>")
    def sign(texts: pa.Array) -> pa.Array:
        digest, size, keys = [], [], []
        for _, part in slices(texts):
            got = list(grams(part, n))
            full = [i for i, (s, _) in enumerate(got) if len(s)]
            sig = signatures([got[i][0] for i in full], bands, rows).view(np.int64) if full else None
            mine = [None] * len(part)
            for k, i in enumerate(full):
                mine[i] = sig[k]
            digest += [d for _, d in got]
            size += [len(s) for s, _ in got]
            keys += mine
        return pa.StructArray.from_arrays([pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                                          ["_digest", "_grams", "_keys"])

    return (small_batches(docs).select("_id", F.xxhash64("_text").alias("_raw"), sign("_text").alias("_s"))
            .select("_id", "_raw", "_s.*"))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """Connected components: ``node, root`` with the least node of each.

    ``edges`` has columns ``a, b``.  Every round hangs each node under the
    least root among its neighbours and then halves the paths; both are joins
    and aggregates over the edges, so a component of any size is never in one
    task.  Every round is checkpointed.
    """
    both = stored(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "roots")
    while True:
        up = roots.select(F.col("node").alias("_n"), F.col("root").alias("_up"))
        # the least root next to each node, counted for its present root as well
        near = (both.join(up, both["b"] == up["_n"]).groupBy("a").agg(F.min("_up").alias("_near")))
        seen = roots.join(near, roots["node"] == near["a"]).select("node", "root", F.least("root", "_near").alias("_best"))
        hung = (seen.select(F.col("node"), F.col("_best"))
                .unionAll(seen.where(F.col("_best") < F.col("root")).select(F.col("root").alias("node"), "_best"))
                .groupBy("node").agg(F.min("_best").alias("_best")))
        top = hung.select(F.col("node").alias("_n"), F.col("_best").alias("_top"))
        short = (hung.join(top, hung["_best"] == top["_n"], "left")
                 .select("node", F.least("_best", F.coalesce("_top", "_best")).alias("root")))
        new = stored(short, "roots")
        before, after = (x.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0] for x in (roots, new))
        if before == after:
            return new
        roots = new


def links_of_block(ids: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray], less: list[list[int]],
                   similarity: float):
    """Links inside a block (``side`` all 0) or between its sides 0 and 1.

    Returns for each text the number of documents linked to it and a spanning
    forest of the links.  ``less`` holds each text's hubs below this one: a
    pair with one in common is counted there.
    """
    m = len(ids)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    # grams with the same owners are one pattern with a weight
    order = np.argsort(flat, kind="stable")
    owner, g = owner[order], flat[order]
    head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    count = np.diff(np.append(head, len(g)))
    tag = mix(np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    code = np.add.reduceat(tag[owner], head)
    shared = np.flatnonzero(count > 1)
    pattern = {}
    for k in shared:
        c = (int(code[k]), int(count[k]))
        if c in pattern:
            pattern[c][1] += 1
        else:
            pattern[c] = [head[k], 1]
    cross = side.any()
    rows = np.flatnonzero(side == 0)
    cols = np.flatnonzero(side == 1) if cross else rows
    common = np.zeros((len(rows), len(cols)), np.float32)
    place = np.zeros(m, np.int64)
    place[cols] = np.arange(len(cols))
    if cross:
        place[rows] = np.arange(len(rows))
    items = [(h, c[1], w) for c, (h, w) in pattern.items()]
    for lo in range(0, len(items), 2048):
        part = items[lo : lo + 2048]
        a = np.zeros((m, len(part)), np.float32)
        for j, (h, c, _) in enumerate(part):
            a[owner[h : h + c], j] = 1
        common += (a[rows] * np.array([w for _, _, w in part], np.float32)) @ a[cols].T
    total = size[rows][:, None] + size[cols][None, :] - common
    linked = common >= similarity * total - 1e-6
    del total, common
    marks = sorted({x for xs in less for x in xs})
    if marks:
        where = {x: j for j, x in enumerate(marks)}
        for lo in range(0, len(marks), 2048):
            a = np.zeros((m, min(2048, len(marks) - lo)), np.float32)
            for i, xs in enumerate(less):
                for x in xs:
                    if lo <= where[x] < lo + 2048:
                        a[i, where[x] - lo] = 1
            used = a.sum(axis=0) > 1
            if used.any():
                linked &= (a[rows][:, used] @ a[cols][:, used].T) == 0
    if not cross:
        np.fill_diagonal(linked, False)
    found = np.zeros(m, np.int64)
    found[rows] += linked @ copies[cols]
    if cross:
        found[cols] += linked.T @ copies[rows]
    # spanning forest by breadth: each text is visited once
    edges, seen = [], np.zeros(m, bool)
    for start in range(m):
        if seen[start]:
            continue
        seen[start] = True
        stack = [start]
        while stack:
            i = stack.pop()
            near = rows[linked[:, place[i]]] if cross and side[i] else cols[linked[place[i]]]
            for j in near[~seen[near]]:
                seen[j] = True
                edges.append((int(ids[i]), int(ids[j])))
                stack.append(j)
    return found, edges


def row_id(id_col: str):
    """The id as it is, of any type that sorts, and before it whether there is
    one: null ids are equal and come first."""
    return F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("value"))


def linked_documents(docs: DataFrame, similarity: float, n: int, recall: float, id_col: str, text_col: str,
                     block_texts: int) -> DataFrame:
    """One row per document (id and words): ``_id, _raw, _class, _first, n``.

    ``_raw`` is the hash of one of its texts, ``_class`` the least id of its
    class, ``_first`` whether it is the one document that stands for the class
    (least id, then least digest), ``n`` its number of links.
    """
    bands, rows = banding(similarity, recall)
    d = docs.select(row_id(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    # texts without words have no digest of their own: each counts as it is
    signed = stored(describe(d, n, bands, rows).withColumn("_bare", F.when(F.col("_grams") == 0, F.col("_raw")))
                    .dropDuplicates(["_id", "_digest", "_bare"]), "signed")
    full = signed.where(F.col("_grams") > 0)
    # numbers in the order of (id, digest): partitions are ranges, sorted inside
    texts = full.groupBy("_digest").agg(F.min("_id").alias("least"), F.min_by("_raw", "_id").alias("raw"), F.count("*").alias("copies"))
    texts = stored(texts.repartitionByRange("least", "_digest").sortWithinPartitions("least", "_digest")
                   .withColumn("rep", F.monotonically_increasing_id()), "texts")

    # hubs: the least representative of each band key
    t = texts.select("_digest", "rep", "least")
    keys = (full.select("_id", "_digest", "_keys").join(t, "_digest").where(F.col("_id") == F.col("least"))
            .select("rep", F.explode("_keys").alias("key")))
    keys = stored(keys, "keys")
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where(F.col("size") > 1)
    member = stored(keys.join(hubs.select("key", "hub"), "key").select("rep", "hub").distinct(), "members")
    # stored, so that both sides of the join are exchanges that Spark can split at a hot hub
    above = stored(member.groupBy(F.col("rep").alias("hub")).agg(F.min("hub").alias("top")), "above")
    member = stored(member.join(above, "hub", "left").select("rep", F.coalesce("top", "hub").alias("hub")).distinct(), "members")

    # the full sets of the members, once each, then dealt to the block pairs
    mine = member.groupBy("rep").agg(F.array_sort(F.collect_set("hub")).alias("hubs"))
    who = texts.join(mine, "rep").select("rep", "least", "raw", "copies", "hubs", "_digest")
    source = d.select(F.col("_id").alias("least"), F.xxhash64("_text").alias("raw"), "_text")

    @F.arrow_udf("struct<digest:binary,grams:binary>")
    def gram_sets(texts: pa.Array) -> pa.Array:
        out = [{"digest": dg, "grams": s.tobytes()} for _, part in slices(texts) for s, dg in grams(part, n)]
        return pa.array(out, pa.struct([("digest", pa.binary()), ("grams", pa.binary())]))

    sets = (source.join(who, ["least", "raw"]).withColumn("_g", gram_sets("_text")).where(F.col("_g.digest") == F.col("_digest"))
            .select("rep", "copies", "hubs", F.col("_g.grams").alias("grams")).dropDuplicates(["rep"]))
    sets = stored(sets, "sets")
    # a hub's group is cut by the number of its texts and of their grams
    load = (sets.select(F.explode("hubs").alias("hub"), (F.octet_length("grams") / 8).alias("g"))
            .groupBy("hub").agg(F.count("*").alias("size"), F.sum("g").alias("g")).where(F.col("size") > 1)
            .select("hub", F.greatest(F.ceil(F.col("size") / block_texts), F.least(F.ceil(F.col("g") / BLOCK_GRAMS), F.col("size"))).cast("int").alias("nb")))
    dealt = (sets.select("rep", F.explode("hubs").alias("hub")).join(load, "hub")
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
             .select("rep", "hub", "own", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")))
    work = (dealt.join(sets, "rep")
            .select("hub", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "rep", "copies",
                    F.filter("hubs", lambda x: x < F.col("hub")).alias("less"), "grams"))

    def compare(batches):
        """Rows come sorted by block pair: gather one, compare it, go on."""
        held, key = [], None

        def finish():
            if len(held) < 2 or (key[1] != key[2] and len({r[0] for r in held}) < 2):
                return [], []
            held.sort(key=lambda r: r[1])
            side = np.array([int(r[0] != key[1]) for r in held])
            ids = np.array([r[1] for r in held], np.int64)
            found, edges = links_of_block(ids, np.array([r[2] for r in held], np.int64), side,
                                          [np.frombuffer(r[4], np.uint64) for r in held], [r[3] for r in held], similarity)
            return [(int(i), int(f)) for i, f in zip(ids, found, strict=True) if f], edges

        def table(counts, edges):
            k = len(counts)
            return pa.RecordBatch.from_arrays([
                pa.array([c[0] for c in counts] + [e[0] for e in edges], pa.int64()),
                pa.array([c[1] for c in counts] + [0] * len(edges), pa.int64()),
                pa.array([None] * k + [e[1] for e in edges], pa.int64())], ["rep", "links", "to"])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("hub", "p", "q", "own", "rep", "copies", "less", "grams")]
            for hub, p, q, own, rep, copies, less, g in zip(*cols, strict=True):
                if (hub, p, q) != key:
                    if held:
                        yield table(*finish())
                    held, key = [], (hub, p, q)
                held.append((own, rep, copies, less, g))
        if held:
            yield table(*finish())

    out = stored(work.repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q")
                 .mapInArrow(compare, "rep long, links long, to long"), "links")
    counts = out.where(F.col("to").isNull()).groupBy("rep").agg(F.sum("links").alias("links"))
    roots = smallest_reachable(out.where(F.col("to").isNotNull()).select(F.col("rep").alias("a"), F.col("to").alias("b")))
    per_text = (texts.join(counts, "rep", "left").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                .select("_digest", "rep", "least", F.coalesce("root", "rep").alias("root"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")))
    head = texts.select(F.col("rep").alias("root"), F.col("least").alias("_class"))
    per_text = per_text.join(head, "root").withColumn("_head", F.when(F.col("rep") == F.col("root"), F.col("least"))).drop("rep", "least", "root")
    return (signed.select("_id", "_raw", "_digest", "_grams").join(per_text, "_digest", "left")
            .select("_id", "_raw", F.coalesce("_class", "_id").alias("_class"),
                    F.coalesce(F.col("_head") == F.col("_id"), F.col("_grams") == 0).alias("_first"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def jaccard_classes(docs: DataFrame, similarity: float = 0.8, n: int = 5, recall: float = 0.9999,
                    id_col: str = "doc_id", text_col: str = "text", block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """One row per document: ``id, class_id, n_links``.

    Two documents are linked if the Jaccard similarity of their sets of
    ``n``-word runs (folded words) is ``similarity`` or more; ``n_links`` counts
    the documents linked to a row, copies included, and ``class_id`` is the
    least id connected with it (ids of any type that sorts).  Texts without words
    are linked to nothing.
    Rows that repeat an id (or have none) are one document if their words are
    equal (without words: their texts), else each counts; a null id sorts before
    all others.  An empty table gives an empty result; other columns are not
    carried.
    """
    linked = linked_documents(docs, similarity, n, recall, id_col, text_col, block_texts)
    return linked.select(F.col("_id.value").alias(id_col), F.col("_class.value").alias("class_id"), F.col("n").alias("n_links"))


def keep_one_row_per_class(docs: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """One row of each class: that of the least id, and of the least digest
    where ids repeat or are null.  Different texts that share an id or have none
    are rows of their own."""
    linked = linked_documents(docs, similarity, n, 0.9999, "doc_id", "text", BLOCK_TEXTS)
    key, raw = fresh(docs, "_key"), fresh(docs, "_raw")
    stay = linked.where("_first").select(F.col("_id").alias(key), F.col("_raw").alias(raw))
    return (docs.withColumn(key, row_id("doc_id")).withColumn(raw, F.xxhash64(text_or_empty("text")))
            .join(stay, [key, raw], "left_semi").dropDuplicates([key, raw]).select(*[F.col(f"`{c}`") for c in docs.columns]))


def keep_one_per_class(docs: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """As :func:`keep_one_row_per_class`, and of rows that repeat an id (or have
    none) one stays: for callers that need unique ids."""
    return keep_one_row_per_class(docs, similarity, n).dropDuplicates(["doc_id"])
