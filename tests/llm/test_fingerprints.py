"""Syncmer fingerprints against a plain Python version."""

import hashlib
import random

import pytest
import xxhash
from llm_samples import docs_of, random_words
from pyspark.sql import functions as F

from wardline.llm import syncmers
from wardline.llm.syncmers import HASH_BITS, K, LOW, PLACE_BITS, S, fingerprint, fingerprint_report, likeness


def xx(code: str) -> int:
    h = xxhash.xxh64_intdigest(code.encode("utf-32-be"), 42)
    return h - (1 << 64) if h >> 63 else h


def plain_print(text, keep=64, k=K, s=S):
    best = {}
    for i in range(len(text) - k + 1):
        inner = [xx(text[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]) and min(inner) < LOW:
            best.setdefault(xx(text[i : i + k]) & ((1 << HASH_BITS) - 1), i)
    if text and not best:
        best[xx(text) & ((1 << HASH_BITS) - 1)] = 0
    return [h << PLACE_BITS | p for h, p in sorted(best.items())][:keep]


def plain_likeness(a, b, keep=64):
    if not a or not b:
        return float(not a and not b)
    limit = min(x[-1] >> PLACE_BITS if len(x) == keep else 1 << HASH_BITS for x in (a, b))
    place = lambda x: {v >> PLACE_BITS: v & ((1 << PLACE_BITS) - 1) for v in x if v >> PLACE_BITS <= limit}
    p, q = place(a), place(b)
    moved = [x for _, x in sorted((p[h], q[h] - p[h]) for h in p.keys() & q.keys())]
    good = sum(m == 0 or m in moved[max(i - 1, 0) : i] or m in moved[i + 1 : i + 2] for i, m in enumerate(moved))
    return 2 * good / (len(p) + len(q)) if len(p) + len(q) > 1 else 0.0


def plain_report(rows):
    order = sorted(((i is not None, i or 0, xx8(t or "")), i, t or "") for i, t in rows)[::-1]
    out = []
    for n, (_, i, t) in enumerate(order):
        follower = order[(n + 1) % len(order)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + follower[:half]
        a, b, c = plain_print(t), plain_print(edited), plain_print(follower)
        hexed = lambda x: "".join(f"{v:016x}" for v in x)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), plain_likeness(a, b), plain_likeness(a, c)))
    return sorted(out, key=repr)


def xx8(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [None, "", " ", "a", "ab", "é" * 700, "😀 emoji 😀" * 9, "x" * 3000]
    out += [" ".join(random_words(i, rng.randrange(1, 400), 500)) for i in range(40)]
    out += [out[20], out[20], out[21][:300] + " put in between " + out[21][300:]]
    out.append(" ".join(random_words(99, 2500, 900)))  # several pieces
    return out


def test_fingerprints_like_plain(spark, texts):
    got = docs_of(spark, texts).select("doc_id", fingerprint(F.coalesce("text", F.lit(""))).alias("p")).collect()
    assert {r.doc_id: list(r.p) for r in got} == {i: plain_print(t or "") for i, t in enumerate(texts)}


def test_report_like_plain(spark, texts):
    ids = [i * 7 % 53 for i in range(len(texts))]
    ids[3] = ids[4] = None
    ids[11] = ids[10]  # two texts of one id
    df = docs_of(spark, texts, ids, extra=True)
    assert rows_of(fingerprint_report(df)) == plain_report(list(zip(ids, texts, strict=True)))


def test_many_blocks_and_equal_rows(spark, texts, monkeypatch):
    monkeypatch.setattr(syncmers, "BLOCK_CHARS", 200)
    rows = [(i, t) for i, t in enumerate(texts[8:48])] + [(15, texts[23])] * 30 + [(None, "no id")] * 25
    df = docs_of(spark, [t for _, t in rows], [i for i, _ in rows])
    want = plain_report(rows)
    assert rows_of(fingerprint_report(df)) == want
    monkeypatch.setattr(syncmers, "HOT_ROWS", 3)  # equal rows travel as one
    assert rows_of(fingerprint_report(df)) == want


def test_one_row_and_no_row(spark, empty):
    assert rows_of(fingerprint_report(empty)) == []
    one = "a single text that follows itself, long enough for anchors"
    assert rows_of(fingerprint_report(docs_of(spark, [one], [4]))) == plain_report([(4, one)])
    assert rows_of(fingerprint_report(docs_of(spark, [None], [None]))) == plain_report([(None, None)])


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one " * 30), ("a", "two " * 40), ('q"\\', "three " * 20)], "doc_id string, text string")
    got = {r.doc_id: r for r in fingerprint_report(docs).collect()}
    edited = "two " * 40
    edited = edited[:80] + ("three " * 20)[:80]  # after the last comes the first
    assert got["a"].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_likeness_follows_moved_passages(spark):
    a = " ".join(random_words(1, 300, 5000))
    b = " ".join(random_words(2, 300, 5000))
    pairs = spark.createDataFrame([(a, a), (a, "some words before " + a), (a, b), ("", ""), (a, "")], "a string, b string")
    pairs = pairs.select(fingerprint(F.col("a")).alias("p"), fingerprint(F.col("b")).alias("q"))
    got = [r[0] for r in pairs.select(likeness(F.col("p"), F.col("q"))).collect()]
    assert got[0] == 1.0 and got[1] > 0.8 and got[2] < 0.1 and got[3] == 1.0 and got[4] == 0.0


def test_no_python_workers(spark, texts):
    plan = fingerprint_report(docs_of(spark, texts))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_every_window_is_looked_at(spark):
    text = " ".join(random_words(7, 30, 400))  # too short for 64 anchors
    want = set()
    for i in range(len(text) - K + 1):
        inner = [xx(text[i + j : i + j + S]) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):  # whatever the least is
            want.add(xx(text[i : i + K]) & ((1 << HASH_BITS) - 1))
    got = docs_of(spark, [text]).select(fingerprint(F.col("text")).alias("p")).first().p
    assert len(want) > 20 and [x >> PLACE_BITS for x in got] == sorted(want)[:64]
    odd = docs_of(spark, [text]).select(fingerprint(F.col("text"), 14, 9).alias("p")).first().p  # six s-mers a k-mer
    assert list(odd) == plain_print(text, k=14, s=9)
