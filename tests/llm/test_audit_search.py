"""Source divergence and ranked search against plain Python versions."""

import math
import random
import re
from collections import Counter

import pytest
from llm_samples import docs_of, random_words

from wardline.llm import audit, lexical
from wardline.llm.audit import divergence
from wardline.llm.lexical import ranked_search


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- source divergence ---------------------------------------------------------------

def plain_divergence(rows, least, top=50):
    fold = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(la or "", so or "", Counter(w.translate(low) for w in fold(t))) for la, so, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = sorted(t for t in df if df[t] >= least)
        total = Counter()
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, c in mine:
            groups[s].update({t: c[t] for t in kept})
            total.update({t: c[t] for t in kept})
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        share, q = {s: p(c) for s, c in groups.items()}, p(total)
        for s in groups:
            pairs = sorted((-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(pairs)]
            terms = sorted((q[t] - share[s][t], t.encode(), t) for t in kept if groups[s][t] and share[s][t] > q[t])
            out += [(lang, s, "term", t, -v, r + 1) for r, (v, _, t) in enumerate(terms[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    letters = "abcdefghij"
    rows = []
    for i in range(200):
        words = ["".join(letters[int(c)] for c in str(rng.randrange(120))) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None]) if i % 3 else "a", "Ä, ".join(words)))
    rows += [("en", "nothing", None), ("xx", "a", "rare words"), ("xx", "b", ""), ("en", "a", rows[0][2])]
    return rows, spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, digest int")


@pytest.mark.parametrize("least", [1, 5, 30])
def test_divergence_like_plain(corpus, least):
    rows, df = corpus
    assert rows_of(divergence(df, least)) == plain_divergence(rows, least)


def test_shared_digests_are_split(corpus):
    rows, df = corpus
    for bits in (0, 4):
        assert rows_of(divergence(df, 10, digest_bits=bits)) == plain_divergence(rows, 10)


def test_blocks_and_flushes_change_nothing(corpus, monkeypatch):
    rows, df = corpus
    monkeypatch.setattr(audit, "HELD", 50)
    assert rows_of(divergence(df, 10, top=3, block_sources=2, block_terms=7)) == plain_divergence(rows, 10, 3)


def test_divergence_edges(spark, edge, empty):
    assert rows_of(divergence(empty)) == []
    got = rows_of(divergence(edge.drop("spans")))
    assert {r[2] for r in got} == {"pair"} and all(r[4] == 0 for r in got)
    long = [("en", "a", "wort " * 400_000 + "x" * 3_000_000), ("en", "b", "wort")]
    df = spark.createDataFrame(long, "lang string, source string, text string")
    assert rows_of(divergence(df, 1)) == plain_divergence(long, 1)


# --- ranked search ------------------------------------------------------------------------

def plain_search(docs, items, k=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: [w.translate(low) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    counts = [(i, Counter(words(t))) for i, t in docs]
    size = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(n > 0 for n in size), sum(size)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in wanted.items():
        found = []
        for (i, c), n in zip(counts, size, strict=True):
            m = 50 + (50 * n * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def library():
    rng = random.Random(8)
    docs = [(i, " ".join(random_words(i, rng.randrange(0, 120), 40 if i % 2 else 900))) for i in range(600)]
    docs += [(600 + i, "w1 w2 same text w77") for i in range(120)]  # ties
    docs += [(None, "w3 w300 w4"), (None, None), (7, "w5 w500"), (7, "w5 w500"), (900, ""), (901, "W1 " * 5000 + "é")]
    items = [(i, " ".join(random_words(1000 + i, rng.randrange(1, 30), 900 if i % 3 else 40))) for i in range(25)]
    items += [(None, "w1 w2"), (None, "w3"), (50, "absent words"), (51, None), (52, ""), (53, "é W77"), (3, "w8 more of item three")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, score int, rank string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("short,segment,block", [(256, 4096, 200_000), (10, 64, 200_000), (0, 100, 60), (10**9, 50, 10)])
def test_search_like_plain(spark, library, monkeypatch, short, segment, block):
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", segment)
    docs, items = library
    a, b = frames(spark, docs, items)
    for k in (50, 3):
        assert rows_of(ranked_search(a, b, k, block_pairs=block)) == plain_search(docs, items, k)


def test_search_edges(spark, edge, empty, library):
    docs, items = library
    a, b = frames(spark, docs, items)
    assert rows_of(ranked_search(empty, b)) == [] == rows_of(ranked_search(a, b.limit(0)))
    assert rows_of(ranked_search(a.withColumn("text", a.text.substr(1, 0)), b)) == []
    texts = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert rows_of(ranked_search(edge, b)) == plain_search(texts, items)
    named = spark.createDataFrame([("b", "w1"), ("a", "w1"), (None, "w1"), ("c", "z")], "name string, body string")
    got = ranked_search(named, b.where("item_id = 0 or item_id is null"), id_col="name", text_col="body").where("item_id is null").orderBy("rank")
    assert [r.doc_id for r in got.collect()] == ["a", "b", None]
