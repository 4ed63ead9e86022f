"""Benchmark decontamination with a generalised suffix automaton (operator 2).

The benchmark's words are normalised and cut into bounded blocks, sent as
broadcasts of proven size.  The Python workers build one suffix automaton over
word numbers of each block and keep it between tasks; the driver builds none.
Training texts stream through them: every word moves to the longest
suffix that still occurs in some item, which gives the longest match ending
there, the words it covers and the items it belongs to.  Texts are never
shuffled.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import pickle
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import packed, sha, small_batches, stored, text_or_empty, unpacked, values, worker_cache
from wardline.llm.textops import FOLD_TABLE
from wardline.session import cut_lineage

#: words of benchmark items in one automaton (under 1 MB sent, about 20 MB when built)
BLOCK_WORDS = 100_000
#: automata that one pass over the documents carries along
BLOCKS_PER_PASS = 4

SCAN = "struct<n_words:long,starts:array<int>,ends:array<int>,longest:int,items:array<string>>"
_SCAN = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                   ("longest", pa.int32()), ("items", pa.list_(pa.string()))])


def words_of(text: str) -> list[bytes]:
    """Words ``[0-9a-z]`` and above 0x7F, after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD_TABLE).split()


class SuffixAutomaton:
    """Generalised over several word sequences; ``window`` words make a hit.

    ``step[s]`` maps a word number to the next state, ``link`` is the suffix
    link, ``size`` the longest string of a state.  ``of_window`` gives the
    items of a state that holds a window; ``of_short`` those of whole items
    below the window, as (length, item) along the suffix links.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.step, self.link, self.size = [{}], [-1], [0]
        coded = []
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            coded.append((item, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.of_window: dict[int, set] = defaultdict(set)
        own_short: dict[int, set] = defaultdict(set)
        for item, ids in coded:
            if 0 < len(ids) < window:
                s = 0
                for c in ids:
                    s = self.step[s][c]
                own_short[s].add((len(ids), item))
            else:
                for s in self.states_of_windows(ids):
                    self.of_window[s].add(item)
        self.of_short: dict[int, tuple] = {}
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__) if own_short else ():
            got = own_short.get(s, set()) | set(self.of_short.get(self.link[s], ()))
            if got:
                self.of_short[s] = tuple(got)

    def _extend(self, last: int, c: int) -> int:
        step, link, size = self.step, self.link, self.size
        if c in step[last]:
            q = step[last][c]
            return q if size[q] == size[last] + 1 else self._split(last, c, q)
        cur = len(size)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            link[cur] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        step, link, size = self.step, self.link, self.size
        twin = len(size)
        step.append(dict(step[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = twin
        while p != -1 and step[p].get(c) == q:
            step[p][c] = twin
            p = link[p]
        return twin

    def states_of_windows(self, ids: list[int]):
        s = n = 0
        for c in ids:
            s, n = self.step[s][c], n + 1
            while self.size[self.link[s]] >= self.window:
                s = self.link[s]
            if n >= self.window:
                n = self.window
                yield s

    def scan(self, words: list[bytes]):
        """Covered intervals (merged), longest match, items that occur."""
        step, link, size, window = self.step, self.link, self.size, self.window
        starts, ends, items, longest = [], [], set(), 0
        s = n = 0
        short = self.of_short
        for i, c in enumerate(map(self.vocab.get, words)):
            if c is None:
                s = n = 0
                continue
            nxt = step[s].get(c)
            while nxt is None and s:
                s = link[s]
                n = size[s]
                nxt = step[s].get(c)
            if nxt is None:
                continue
            s, n = nxt, n + 1
            if n > longest:
                longest = n
            covers = n if n >= window else 0
            if covers:
                t = s
                while size[link[t]] >= window:
                    t = link[t]
                items |= self.of_window[t]
            if short and s in short:
                for k, item in short[s]:
                    if k <= n:
                        covers = max(covers, k)
                        items.add(item)
            if covers:
                a = i + 1 - covers
                while starts and starts[-1] > a:  # a longer match may reach back over several
                    starts.pop(), ends.pop()
                if starts and ends[-1] >= a:
                    ends[-1] = i + 1
                else:
                    starts.append(a)
                    ends.append(i + 1)
        return starts, ends, longest, items


def merge(a, b):
    """Union of two lists of intervals."""
    starts, ends = [], []
    for x, y in sorted([*zip(*a, strict=True), *zip(*b, strict=True)]):
        if starts and x <= ends[-1]:
            ends[-1] = max(ends[-1], y)
        else:
            starts.append(x)
            ends.append(y)
    return starts, ends


def item_blocks(benchmark: DataFrame, window: int, block_words: int, item_col: str, text_col: str):
    """Yield the benchmark as bounded lists of (item id, words joined by a blank).

    Items longer than a piece are cut into pieces that overlap by
    ``window - 1`` words and repeated pieces count once, so a list holds about
    ``block_words`` words however the benchmark is made.  The pieces are written
    once, a folder per block, so each block reads its own rows only.
    """
    piece = max(block_words // 50, 2 * window)
    word = F.expr("regexp_extract_all(translate(_text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                  "'[^\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+', 0)")
    pieces = (benchmark.select(F.col(item_col).cast("string").alias("_item"), text_or_empty(text_col).alias("_text"))
              .select("_item", word.alias("_words")).where(F.size("_words") > 0)
              .select("_item", "_words", F.explode(F.sequence(
                  F.lit(0), F.greatest(F.size("_words") - window, F.lit(0)), F.lit(piece))).alias("_at"))
              .select("_item", F.col("_at"), F.slice("_words", F.col("_at") + 1, F.lit(piece + window - 1)).alias("_words"))
              .select("_item", F.array_join("_words", " ").alias("_words"), F.size("_words").alias("_n")).distinct())
    total = pieces.agg(F.sum("_n")).first()[0] or 0
    if not total:
        return
    n = math.ceil(total / block_words)
    block = F.pmod(F.xxhash64("_item", "_words"), F.lit(n)).cast("int").alias("_block")
    blocks = stored(pieces.select("_item", "_words", block).repartition(n, "_block"), "items", by="_block")
    for b in range(n):
        rows = blocks.where(F.col("_block") == b).collect()
        if rows:
            yield sorted(((r["_item"], r["_words"]) for r in rows), key=lambda x: (x[0] is not None, x))


def sent_blocks(spark, blocks: list[list[tuple]]):
    """A broadcast of blocks, as (digest, pickled plain rows) each: the workers
    need no class of this package to read it."""
    plain = [pickle.dumps(b) for b in blocks]
    return spark.sparkContext.broadcast([(hashlib.sha256(p).hexdigest(), p) for p in plain])


def automata(sent, window: int) -> list[SuffixAutomaton]:
    """The automata of a broadcast of blocks, built once in a worker process.
    Those of one broadcast are kept, so a worker holds ``BLOCKS_PER_PASS``."""
    key = (window, [digest for digest, _ in sent.value])
    cache = worker_cache()
    if cache.get("automata_key") != key:
        cache["automata_key"] = cache["automata"] = None  # frees the last ones first
        cache["automata"] = [
            SuffixAutomaton([(item, words.encode("utf-8", "surrogatepass").split()) for item, words in pickle.loads(rows)], window)
            for _, rows in sent.value]
        cache["automata_key"] = key
    return cache["automata"]


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", out: str = "_scan",
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``out``: words, covered word intervals, longest match and
    the ids of items with a window in the text.

    A null text (document or item) has no words; a null item id is left out of
    the ids but its windows count; repeated rows are each scanned; with an
    empty benchmark nothing is covered.  Columns of ``docs`` are kept; one
    named like ``out`` is replaced.
    """
    spark = docs.sparkSession

    def scan_pass(df: DataFrame, blocks: list[list[tuple]]) -> DataFrame:
        sent = sent_blocks(spark, blocks)

        @F.arrow_udf(SCAN)
        def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
            autos, rows = automata(sent, window), []
            for t, old in zip(values(texts), values(before), strict=True):
                words = words_of(t)
                starts, ends, longest, items = [], [], 0, set()
                if old is not None:
                    starts, ends, longest, items = old["starts"], old["ends"], old["longest"], set(old["items"])
                for auto in autos:
                    some_starts, some_ends, reach, names = auto.scan(words)
                    starts, ends = merge((starts, ends), (some_starts, some_ends))
                    longest = max(longest, reach)
                    items |= names
                rows.append({"n_words": len(words), "starts": starts, "ends": ends, "longest": longest,
                             "items": sorted(x for x in items if x is not None)})
            return pa.array(rows, _SCAN)

        return small_batches(df).withColumn(out, scan(text_or_empty(text_col), F.col(out)))

    df = docs.withColumn(out, F.lit(None).cast(SCAN))
    passes = itertools.batched(item_blocks(benchmark, window, block_words, item_col, item_text_col), BLOCKS_PER_PASS)
    df = scan_pass(df, next(passes, ()))
    for blocks in passes:
        df = scan_pass(cut_lineage(df), blocks)
    return df


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Per row: words, words inside occurrences of windows, items that occur."""
    s = scan_documents(docs.select(F.col(id_col), F.col("text")), benchmark, window)
    hit = F.aggregate(F.zip_with("_scan.starts", "_scan.ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return s.select(id_col, F.col("_scan.n_words").alias("n_words"), hit.alias("n_hit"),
                    F.size("_scan.items").cast("long").alias("n_items"),
                    sha(F.array_join("_scan.items", ",")).alias("items_sha256"),
                    (F.size("_scan.starts") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  text_col: str = "text") -> DataFrame:
    """Remove benchmark spans from the texts.

    Spans of matches of ``window`` words or more (or of whole shorter items)
    are cut out of the text, together with the characters between their
    words; what is left is scanned again until no match is left.  A document
    with more than ``max_coverage`` of its words covered at first, by all
    items together, is dropped.  Other rows and columns stay as they are, also
    null and empty texts and repeated rows; an empty benchmark or table changes
    nothing.  However many passes a large benchmark takes, the result is that
    of one pass.
    """
    spark = docs.sparkSession
    columns = docs.columns
    blocks = item_blocks(benchmark, window, BLOCK_WORDS, "item_id", "text")
    first = list(itertools.islice(blocks, BLOCKS_PER_PASS))
    rows = packed(docs).withColumn("_text", F.col("_row")[text_col].cast("string"))
    if next(blocks, None) is not None:
        return unpacked(cut_in_passes(rows, benchmark, window, max_coverage), columns, **{text_col: F.col("_text")})
    if not first:
        return docs
    sent = sent_blocks(spark, first)

    @F.arrow_udf("struct<text:string,keep:boolean>")
    def clean(texts: pa.Array) -> pa.Array:
        autos = automata(sent, window)
        return pa.array([cut(t, autos, max_coverage) for t in values(texts)],
                        pa.struct([("text", pa.string()), ("keep", pa.bool_())]))

    done = small_batches(rows).withColumn("_cut", clean("_text")).where(F.col("_cut")["keep"])
    return unpacked(done, columns, **{text_col: F.col("_cut")["text"]})


def cut_in_passes(rows: DataFrame, benchmark: DataFrame, window: int, max_coverage: float) -> DataFrame:
    """``rows`` (``_row, _text``) cut like by one pass: every round collects the
    spans of all blocks, then cuts; rows that were cut go into the next round."""

    @F.arrow_udf("string")
    def without(texts: pa.Array, scans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(values(texts), values(scans), strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            folded = raw.translate(FOLD_TABLE)
            out.append(outside(raw, folded, folded.split(), s["starts"], s["ends"]).decode("utf-8", "surrogatepass"))
        return pa.array(out, pa.string())

    finished, first = None, True
    while True:
        scanned = stored(scan_documents(rows, benchmark, window, "_text"), "scanned")
        hit = F.size("_scan.starts") > 0
        clean = scanned.where(~hit).select("_row", "_text")
        finished = clean if finished is None else finished.unionByName(clean)
        found = scanned.where(hit)
        if first:
            covered = F.aggregate(F.zip_with("_scan.starts", "_scan.ends", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
            found = found.where(covered <= F.lit(max_coverage) * F.col("_scan.n_words"))
            first = False
        rows = stored(small_batches(found).select("_row", without("_text", "_scan").alias("_text")), "cut")
        if rows.isEmpty():
            return finished


def outside(raw: bytes, folded: bytes, words: list[bytes], starts: list[int], ends: list[int]) -> bytes:
    """The text without the word intervals."""
    places, at = [], 0
    for w in words:
        at = folded.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    kept, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]])


def cut(text: str | None, autos: list[SuffixAutomaton], max_coverage: float) -> dict:
    """Text without covered spans, and whether the document stays."""
    raw = None if text is None else text.encode("utf-8", "surrogatepass")
    first = True
    while raw:
        folded = raw.translate(FOLD_TABLE)
        words = folded.split()
        starts, ends = [], []
        for a in autos:
            starts, ends = merge((starts, ends), a.scan(words)[:2])
        if not starts:
            break
        if first and sum(ends) - sum(starts) > max_coverage * len(words):
            return {"text": text, "keep": False}
        first = False
        raw = outside(raw, folded, words, starts, ends)
    return {"text": text if first else raw.decode("utf-8", "surrogatepass"), "keep": True}
