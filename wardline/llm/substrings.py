"""Repeated passages by fixed-block anchors (operator 7).

A passage of ``window`` words that occurs twice holds, at either place, a whole
block of the grid of non-overlapping blocks of ``(window + 1) // 2`` words.
So the blocks of every document are indexed, every rolling window of a block's
length probes the index, and only windows that hold a hit are extended to the
full ``window`` and compared; overlapping repeats join to maximal ones.

Documents are dealt into chunks of a few MB.  A chunk sends, to each bucket of
hash values, one packed row of its distinct values, so a passage in millions
of documents is one value per chunk; a bucket answers each chunk with the
values that repeat.  The three passes over a chunk share one exchange of the
documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import sha, stored, text_or_empty
from wardline.llm.textops import BLANK_WORDS, find_words, hash_words, join_texts, mix, windows

#: bytes of text in a chunk and rolling windows in a bucket, about
CHUNK_BYTES, BUCKET_VALUES = 4 << 20, 2 << 20

ANCHOR, TWICE = 1, 2


def chunk_words(texts: list[bytes], block: int):
    """Hash of the block-long window at each word, the text of each word and
    the word's place in its text."""
    buf, at = join_texts(texts)
    starts, ends = find_words(buf, BLANK_WORDS)
    doc = np.searchsorted(at, starts, "right") - 1
    first = np.searchsorted(starts, at)
    place = np.arange(len(starts)) - first[doc] if len(starts) else np.zeros(0, np.int64)
    return windows(hash_words(buf, starts, ends), block), doc, place, first


def inside(doc: np.ndarray, size: int) -> np.ndarray:
    """Whether the window at each position stays in one text."""
    return doc[: len(doc) - size + 1] == doc[size - 1 :] if len(doc) >= size else np.zeros(0, bool)


def distinct(values: np.ndarray, flags: np.ndarray):
    """Sorted distinct values; the flags of equal ones are united, and TWICE
    is set for values that occur again."""
    order = np.argsort(values, kind="stable")
    v, f = values[order], flags[order]
    if not len(v):
        return v, f
    head = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    f = np.bitwise_or.reduceat(f, head)
    f[np.diff(np.append(head, len(v))) > 1] |= TWICE
    return v[head], f


def by_bucket(chunk: int, values: np.ndarray, flags: np.ndarray, bits: int, width: int) -> pa.Table:
    """One row per bucket (the leading ``bits``) with packed values.

    ``width`` bytes of each value after the leading bits are sent."""
    bucket = (values >> np.uint64(64 - bits)).astype(np.int32)
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    rest = values << np.uint64(bits)
    body = (rest >> np.uint64(32)).astype("<u4") if width == 4 else rest.astype("<u8")
    cuts = np.append(heads, len(values))
    return pa.table({
        "_bucket": pa.array(bucket[heads], pa.int32()), "_chunk": pa.array(np.full(len(heads), chunk), pa.int32()),
        "_values": pa.array([body[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        "_flags": pa.array([flags[a:b].astype(np.uint8).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


PROBES = "_bucket int, _chunk int, _values binary, _flags binary"
ANSWERS = "_chunk int, _values binary"
_ANSWERS = pa.schema([("_chunk", pa.int32()), ("_values", pa.binary())])


def repeats_of_bucket(table: pa.Table, width: int, need: int) -> pa.Table:
    """Answer each chunk with its values that repeat and have the flags ``need``
    somewhere; values keep their packed form."""
    kind = "<u4" if width == 4 else "<u8"
    parts = [np.frombuffer(x, kind) for x in table.column("_values").to_pylist()]
    flags = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("_flags").to_pylist()])
    values = np.concatenate(parts)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(values, kind="stable")
    v = values[order]
    head = np.append(True, v[1:] != v[:-1])
    group = np.cumsum(head) - 1
    at = np.flatnonzero(head)
    united = np.bitwise_or.reduceat(flags[order], at)
    again = (np.diff(np.append(at, len(v))) > 1) | (united & TWICE > 0)
    good = (again & (united & need == need))[group]
    hit = order[good]
    hit.sort()
    cuts = np.searchsorted(row[hit], np.arange(len(parts) + 1))
    chunks = table.column("_chunk").to_pylist()
    bucket = table.column("_bucket")[0].as_py()
    out = [(chunks[i], np.int32(bucket).tobytes() + values[hit[a:b]].tobytes())
           for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return pa.table({"_chunk": [x[0] for x in out], "_values": [x[1] for x in out]}, schema=_ANSWERS)


def answered(table: pa.Table, bits: int, width: int) -> np.ndarray:
    """The values of all answers to a chunk: the leading bits and the bytes sent."""
    out = []
    for x in table.column("_values").to_pylist():
        bucket = np.uint64(np.frombuffer(x[:4], np.int32)[0])
        rest = np.frombuffer(x[4:], "<u4" if width == 4 else "<u8").astype(np.uint64)
        rest = (rest << np.uint64(32)) if width == 4 else rest
        out.append((bucket << np.uint64(64 - bits)) | (rest >> np.uint64(bits)))
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def truncated(values: np.ndarray, bits: int, width: int) -> np.ndarray:
    """What is left of values after they were sent with ``width`` bytes."""
    if width == 8:
        return values
    drop = np.uint64(32 - bits)
    return (values >> drop) << drop


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def full_windows(short: np.ndarray, block: int, window: int) -> np.ndarray:
    """Hash of each full window from the two short ones that cover it."""
    n = len(short) - (window - block)
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix(short[:n] * np.uint64(0xA0761D6478BD642F) + short[window - block :] * np.uint64(0xE7037ED1A0B428DB))


def dealt(rows: DataFrame, chunks: int) -> DataFrame:
    """``rows`` with their ``_chunk``, written once: the row's number takes part,
    so that equal rows spread over all chunks, and every pass finds a row in
    the same chunk."""
    chunk = F.pmod(F.xxhash64("_id", "_text", F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
    return stored(rows.withColumn("_chunk", chunk), "dealt", "zstd")


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = CHUNK_BYTES, bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """One row per input row: ``id, n_words, n_removed, kept``.

    A word is removed if it is covered by ``window`` consecutive words whose
    sequence also starts at any other place of any row; ``kept`` joins the
    other words by one blank.  A null text has no words; repeated rows repeat
    each other, so their long passages go; an empty table gives an empty
    result; other columns are not carried.
    """
    if window % 2 == 0:
        raise ValueError("an odd window is covered by two blocks")
    block = (window + 1) // 2
    d = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    size = d.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    chunks = max(8, math.ceil(size / chunk_bytes))
    bits = max(3, math.ceil(math.log2(max(1, size / 6 / bucket_values))))
    d = dealt(d, chunks)

    def texts_of(table: pa.Table) -> list[bytes]:
        return table.column("_text").cast(pa.binary()).to_pylist()

    def probe(table: pa.Table) -> pa.Table:
        short, doc, place, _ = chunk_words(texts_of(table), block)
        ok = inside(doc, block)
        flags = (place[: len(short)][ok] % block == 0).astype(np.uint8) * np.uint8(ANCHOR)
        v, f = distinct(truncated(short[ok], bits, 4), flags)
        return by_bucket(table.column("_chunk")[0].as_py(), v, f, bits, 4)

    def candidates(short, doc, known) -> np.ndarray:
        """Places whose full window holds a hit."""
        hit = among(truncated(short, bits, 4), known) & inside(doc, block)
        run = np.concatenate([[0], np.cumsum(hit)])
        n = max(len(doc) - window + 1, 0)
        span = window - block + 1
        return np.flatnonzero((run[span : span + n] > run[:n]) & inside(doc, window))

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return by_bucket(0, np.zeros(0, np.uint64), np.zeros(0, np.uint8), bits, 8)
        short, doc, _, _ = chunk_words(texts_of(left), block)
        at = candidates(short, doc, answered(right, bits, 4))
        full = full_windows(short, block, window)[at]
        v, f = distinct(full, np.zeros(len(full), np.uint8))
        return by_bucket(left.column("_chunk")[0].as_py(), v, f, bits, 8)

    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        raw = texts_of(left)
        n = np.zeros(len(raw), np.int64)
        removed = np.zeros(len(raw), np.int64)
        kept = []
        if right.num_rows:
            short, doc, _, first = chunk_words(raw, block)
            full = full_windows(short, block, window)
            again = np.flatnonzero(among(full, answered(right, bits, 8)) & inside(doc, window))
            edge = np.zeros(len(doc) + 1, np.int64)
            np.add.at(edge, again, 1)
            np.add.at(edge, again + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
        for i, t in enumerate(raw):
            words = t.split()
            n[i] = len(words)
            if right.num_rows and (g := gone[first[i] : first[i + 1]]).any():
                removed[i] = g.sum()
                words = [words[k] for k in np.flatnonzero(~g)]
            kept.append(b" ".join(words))
        return pa.table({id_col: left.column("_id"), "n_words": n, "n_removed": removed,
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    by_chunk = d.groupBy("_chunk")
    hits = (by_chunk.applyInArrow(probe, PROBES).groupBy("_bucket")
            .applyInArrow(lambda t: repeats_of_bucket(t, 4, ANCHOR), ANSWERS))
    again = (by_chunk.cogroup(hits.groupBy("_chunk")).applyInArrow(extend, PROBES).groupBy("_bucket")
             .applyInArrow(lambda t: repeats_of_bucket(t, 8, 0), ANSWERS))
    kind = docs.schema[id_col].dataType.simpleString()
    out = by_chunk.cogroup(again.groupBy("_chunk")).applyInArrow(
        strip, f"`{id_col}` {kind}, n_words long, n_removed long, kept string")
    return out


def substring_report(docs: DataFrame, window: int = 35, id_col: str = "doc_id") -> DataFrame:
    return remove_repeats(docs, window, id_col).select(id_col, "n_words", "n_removed", sha(F.col("kept")).alias("kept_sha256"))
