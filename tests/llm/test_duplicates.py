import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_samples import EDGE_TEXTS, docs_of, random_words
from wardline.llm import jaccard, substrings


def shingles(text, n=5):
    w = text.lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_classes(texts, limit=0.8):
    s = [shingles(t or "") for t in texts]
    links = defaultdict(set)
    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= limit * len(s[i] | s[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in range(len(s)):
        stack, seen = [i], {i}
        while stack:
            for j in links[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        root[i] = min(seen)
    return {i: (root[i], len(links[i])) for i in range(len(s))}


def near_copies(seed, groups=12, most=40):
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = random_words(seed * 77 + g, rng.randrange(3, 150), 5000)
        for _ in range(rng.choice([1, 2, 5, most])):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(9)}"
            texts.append(" ".join(t))
    texts += ["", None, "one", "one", "one two three four"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block_texts", [1024, 7])
def test_classes_equal_brute_force(spark, block_texts):
    texts = near_copies(3)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(docs_of(spark, texts), block_texts=block_texts).collect()}
    assert got == brute_classes(texts)


def test_block_counts_and_hub_rule():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30, 40).astype(np.uint64)) for _ in range(40)]
    ids, copies = np.arange(40), rng.integers(1, 4, 40)
    jac = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) - 1e-9
    less = [[int(x) for x in np.flatnonzero(rng.random(3) < 0.3)] for _ in range(40)]
    pair = np.array([[i != j and jac(sets[i], sets[j]) and not set(less[i]) & set(less[j]) for j in range(40)] for i in range(40)])
    found, edges = jaccard.links_of_block(ids, copies, np.zeros(40, int), sets, less, 0.8)
    assert found.tolist() == (pair @ copies).tolist()
    assert all(pair[a, b] for a, b in edges)
    side = (ids % 3 == 0).astype(int)
    cross = pair & (side[:, None] != side[None, :])
    found, edges = jaccard.links_of_block(ids, copies, side, sets, less, 0.8)
    assert found.tolist() == (cross @ copies).tolist()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    names = list(range(3000))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(0, 60)] + [(names[100], names[i]) for i in range(101, 1500)] + [(names[2000], names[2001])]
    got = {r["node"]: r["root"] for r in jaccard.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for group in (names[:61], names[100:1500], names[2000:2002]):
        want |= dict.fromkeys(group, min(group))
    assert got == want


def test_banding_reaches_the_recall():
    bands, rows = jaccard.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


def test_duplicates_edge_cases(spark, edge, empty):
    rows = jaccard.jaccard_classes(edge).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append((r["class_id"], r["n_links"]))
    assert by[6] == [(6, 0)] and len(by[None]) == 2  # equal rows of one id are one document
    assert jaccard.jaccard_classes(empty).count() == 0
    kept = jaccard.keep_one_per_class(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(i) for i in by})
    assert jaccard.keep_one_per_class(empty).count() == 0
    three = docs_of(spark, ["a b c d e f"] * 3 + ["z y x w v u"])
    assert sorted(r["doc_id"] for r in jaccard.keep_one_per_class(three).collect()) == [0, 3]


def test_texts_that_share_an_id_or_have_none(spark):
    base = [" ".join(random_words(900 + i, 40, 5000)) for i in range(5)]
    # three texts under no id, two under id 7, near copies of two of them elsewhere
    texts = [*base[:3], base[3], base[4], base[1] + " x", base[4] + " y", base[0], "!", "?", "!"]
    ids = [None, None, None, 7, 7, 3, 9, None, None, None, None]
    docs = docs_of(spark, texts, ids)
    got = sorted((tuple(r) for r in jaccard.jaccard_classes(docs).collect()), key=repr)
    want = [(None, None, 0)] * 4 + [(None, None, 1), (3, None, 1), (7, 7, 0), (7, 7, 1), (9, 7, 1)]
    assert got == sorted(want, key=repr)
    kept = sorted(r["text"] for r in jaccard.keep_one_row_per_class(docs).collect())
    assert kept == sorted([*base, "!", "?"])


def test_ids_of_any_type(spark):
    base = [" ".join(random_words(950 + i, 40, 5000)) for i in range(3)]
    texts, ids = [base[0], base[0] + " x", base[1], base[1], base[2]], ["b", "a", None, "2024-1", "c"]
    docs = docs_of(spark, texts).drop("doc_id")
    docs = spark.createDataFrame([(i, *r) for i, r in zip(ids, docs.collect(), strict=True)], "doc_id string, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(docs).collect()}
    assert got == {"a": ("a", 1), "b": ("a", 1), None: (None, 1), "2024-1": (None, 1), "c": ("c", 0)}
    kept = jaccard.keep_one_row_per_class(docs.withColumnRenamed("n_chars", "a.b"))
    assert kept.columns[-1] == "a.b"
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["None", "a", "c"]
    least = docs_of(spark, [base[0], base[0]], [-(2**63), None])
    assert {tuple(r) for r in jaccard.jaccard_classes(least).collect()} == {(None, None, 1), (-(2**63), None, 1)}


def brute_repeats(texts, k):
    words = [[w.decode() for w in (t or "").encode().split()] for t in texts]
    at = defaultdict(list)
    for d, w in enumerate(words):
        for i in range(len(w) - k + 1):
            at[tuple(w[i : i + k])].append((d, i))
    gone = {(d, i + j) for places in at.values() if len(places) > 1 for d, i in places for j in range(k)}
    return sorted((len(w), sum((d, i) in gone for i in range(len(w))),
                   hashlib.sha256(" ".join(x for i, x in enumerate(w) if (d, i) not in gone).encode()).hexdigest()) for d, w in enumerate(words))


def shared_passages(seed):
    rng = random.Random(seed)
    pool = [random_words(seed * 50 + i, rng.randrange(5, 90), 3000) for i in range(10)]
    texts = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(pool) if rng.random() < 0.6 else random_words(rng.random(), rng.randrange(60), 3000)
            a = rng.randrange(len(p) + 1)
            w += p[a : a + rng.randrange(100)]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    return [*texts, None, "", "r " * 36, "q " * 35, "é " * 40 + "\x0b\x0c x"]


@pytest.mark.parametrize(("seed", "chunk_bytes", "values"), [(1, 4 << 20, 2 << 20), (2, 500, 20)])
def test_removal_equals_brute_force(spark, seed, chunk_bytes, values):
    texts = shared_passages(seed)
    for k in (35, 7):
        rows = substrings.remove_repeats(docs_of(spark, texts), k, chunk_bytes=chunk_bytes, bucket_values=values).collect()
        assert sorted((r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in rows) == brute_repeats(texts, k)


def test_removal_edge_cases(spark, edge, empty):
    rows = substrings.substring_report(edge).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows) == brute_repeats(EDGE_TEXTS, 35)
    assert substrings.substring_report(empty).count() == 0


def test_equal_rows_spread_over_chunks(spark):
    text = " ".join(random_words(5, 50, 3000))
    rows = docs_of(spark, [text] * 4000 + ["r s t"] * 10, [None] * 4010).select("doc_id", "text")
    sizes = [r["count"] for r in substrings.dealt(rows.toDF("_id", "_text"), 8).groupBy("_chunk").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 700
    got = substrings.remove_repeats(rows).collect()
    assert sorted({(r["n_words"], r["n_removed"]) for r in got}) == [(3, 0), (50, 50)] and len(got) == 4010
