import hashlib
import os
import random
import subprocess
import sys

import pytest
from llm_samples import EDGE_TEXTS, docs_of, random_words
from pyspark.sql import functions as F

from wardline.llm import decontam, queries, tokens

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return queries.tokenizer_bytes()


@pytest.fixture(scope="module")
def transducer(model):
    return tokens.Transducer(model)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def odd_texts(pieces, n, seed=1):
    rng = random.Random(seed)
    for _ in range(n):
        k = rng.randrange(5)
        if k == 0:
            yield "".join(rng.choice("ab \n▁eèinrt  ") for _ in range(rng.randrange(60)))
        elif k == 1:
            yield "".join(rng.choice(pieces) for _ in range(rng.randrange(30))).replace("▁", rng.choice([" ", "", "▁"]))
        elif k == 2:
            yield " " * rng.randrange(70) + rng.choice(["", "x", "the", "\n", "</s>", "<0x0A>"])
        elif k == 3:
            yield "".join(rng.choice(rng.choice(pieces)) for _ in range(rng.randrange(50)))
        else:
            yield "".join(chr(rng.choice([rng.randrange(1, 300), rng.randrange(0xE000, 0x20000), 97, 32])) for _ in range(rng.randrange(40)))


def test_counts_equal_the_library(transducer, library):
    for t in [*odd_texts(list(transducer.score), 2500), *[x or "" for x in EDGE_TEXTS]]:
        assert transducer.count(t) == len(library.encode(t)), repr(t[:100])


def test_chunk_maps_compose(transducer, library, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 7)
    for t in odd_texts(list(transducer.score), 700, seed=2):
        assert transducer.count(t) == len(library.encode(t)), repr(t)
    a, b, c = (transducer.chunk_map(x) for x in ("▁one▁tw", "o▁three\nfo", "ur▁five"))
    assert transducer.compose(transducer.compose(a, b), c) == transducer.compose(a, transducer.compose(b, c))


def test_caches_are_bounded_and_do_not_change_counts(model, library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_STATES", 50)
    monkeypatch.setattr(tokens, "MAX_WORDS", 20)
    t = tokens.Transducer(model)
    for x in odd_texts(list(t.score), 300, seed=4):
        assert t.count(x) == len(library.encode(x))
        assert len(t.words) <= 20


def test_count_tokens(spark, edge, empty, model, library):
    rows = tokens.count_tokens(edge, model).collect()
    want = sorted((len((t or "").encode()), len(library.encode(t or ""))) for t in EDGE_TEXTS)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)
    assert tokens.count_tokens(empty, model).count() == 0


def test_unknown_model_rules_are_refused(model):
    with pytest.raises(ValueError):
        tokens.read_pieces(model.replace(b"identity", b"nmt_nfkc"))


def brute(words, items, window=10):
    hit, ids = set(), set()
    for item, iw in items:
        k = min(window, len(iw))
        grams = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if k and tuple(words[i : i + k]) in grams:
                hit.update(range(i, i + k))
                if item is not None:
                    ids.add(item)
    return hit, ids


def sample(seed):
    rng = random.Random(seed)
    items = [(i, random_words(seed * 100 + i, rng.choice([0, 1, 3, 9, 10, 11, 40]), 4)) for i in range(8)]
    texts = []
    for _ in range(40):
        t = random_words(rng.random(), rng.randrange(60), 4)
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1]
            a = rng.randrange(len(w) + 1)
            t[rng.randrange(len(t) + 1) : 0] = w[a : a + rng.randrange(1, 30)]
        texts.append(t)
    return items, texts


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_brute_force(seed):
    items, texts = sample(seed)
    coded = [(str(i), [x.encode() for x in w]) for i, w in items]
    a = decontam.SuffixAutomaton(coded, 10)
    for t in texts:
        starts, ends, longest, ids = a.scan([x.encode() for x in t])
        hit = {p for s, e in zip(starts, ends, strict=True) for p in range(s, e)}
        assert (hit, ids) == brute(t, [(str(i), w) for i, w in items])
        best = max([0, *(k for i, w in items for s in range(len(w)) for k in range(1, len(w) - s + 1)
                         if any(t[j : j + k] == w[s : s + k] for j in range(len(t))))]) if len(t) < 25 else None
        assert best is None or longest == best


def bench_of(spark, items):
    return spark.createDataFrame([(i, None if w is None else " ".join(w)) for i, w in items], "item_id long, text string")


@pytest.mark.parametrize("block_words", [100_000, 60])
def test_report_with_one_or_many_blocks(spark, block_words):
    items, texts = sample(9)
    texts = [[w.upper() if k % 2 else w for w in t] for k, t in enumerate(texts)]
    df = docs_of(spark, [". ".join(t) for t in texts])
    s = decontam.scan_documents(df, bench_of(spark, [*items, (99, None)]), 10, block_words=block_words).collect()
    for r in s:
        t = [w.lower() for w in texts[r["doc_id"]]]
        hit, ids = brute(t, [(str(i), w) for i, w in items])
        got = {p for a, b in zip(r["_scan"]["starts"], r["_scan"]["ends"], strict=True) for p in range(a, b)}
        assert got == hit and r["_scan"]["items"] == sorted(ids) and r["_scan"]["n_words"] == len(t)


def test_report_edge_cases(spark, edge, empty):
    bench = bench_of(spark, [(1, ["same", "words"]), (None, ["a", "b", "c"]), (2, []), (3, None), (4, ["word"] * 30)])
    rows = decontam.contamination_report(edge, bench).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by = {r["n_words"]: r for r in rows}
    assert by[30000]["n_hit"] == 30000 and by[30000]["items_sha256"] == hashlib.sha256(b"4").hexdigest()
    assert by[3]["contaminated"] and by[3]["n_items"] == 0  # its item has no id
    assert sorted(r["n_hit"] for r in rows if r["n_words"] == 4) == [0, 2, 2]
    assert decontam.contamination_report(empty, bench).count() == 0
    none = decontam.contamination_report(edge, bench.where("false")).collect()
    assert len(none) == len(EDGE_TEXTS) and not any(r["contaminated"] for r in none)


def test_decontaminate(spark, edge, empty):
    item = random_words(1, 20, 1000)
    clean = random_words(2, 60, 1000)
    bench = bench_of(spark, [(1, item)])
    texts = [" ".join(clean), " ".join(clean[:30] + item + clean[30:]), " ".join(item), None, " ".join(clean + item[:9])]
    got = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs_of(spark, texts), bench).collect()}
    assert got == {0: texts[0], 1: " ".join(clean[:30]) + "  " + " ".join(clean[30:]), 3: None, 4: texts[4]}
    # joining what is left may make a new match: it goes as well
    nested = " ".join(clean[:15] + item[:5] + item[:12] + item[5:] + clean[15:])
    left = decontam.decontaminate(docs_of(spark, [nested * 1]), bench).collect()[0]["text"].split()
    assert not brute(left, [(1, item)])[0] and set(clean) <= set(left)
    out = decontam.decontaminate(edge, bench)
    assert out.columns == edge.columns and out.count() == len(EDGE_TEXTS)
    assert decontam.decontaminate(empty, bench).count() == 0
    assert decontam.decontaminate(edge, bench.where("false")).count() == len(EDGE_TEXTS)


@pytest.mark.parametrize("per_pass", [1, 2, 4])
def test_number_of_passes_does_not_show(spark, monkeypatch, per_pass):
    items = [(i, random_words(100 + i, 30, 1000)) for i in range(8)]
    clean = random_words(2, 120, 1000)
    texts = [" ".join(clean[:40] + items[k][1] + clean[40:80] + items[k + 4][1][:14] + clean[80:]) for k in range(4)]
    texts += [" ".join(clean[:62] + items[0][1] + items[5][1]),  # 49 percent, half of it by each of two items
              " ".join(items[1][1][:5] + items[2][1] + items[1][1][5:]), None, "", " ".join(clean)]
    df = docs_of(spark, texts).withColumn("a.b", F.col("doc_id"))
    want = [tuple(r) for r in decontam.decontaminate(df, bench_of(spark, items), max_coverage=0.45).orderBy("doc_id").collect()]
    assert [r[0] for r in want] == [0, 1, 2, 3, 6, 7, 8]
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 40)
    monkeypatch.setattr(decontam, "BLOCKS_PER_PASS", per_pass)
    got = [tuple(r) for r in decontam.decontaminate(df, bench_of(spark, items), max_coverage=0.45).orderBy("doc_id").collect()]
    assert got == want


def test_blocks_hold_each_piece_once_also_without_ids(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(40)]
    items = [(None, t) for t in texts] + [(None, texts[0])] * 200 + [("x", "A a-A")] * 50
    bench = spark.createDataFrame([*items, ("y", None), ("z", "--")], "item_id string, text string")
    blocks = list(decontam.item_blocks(bench, 10, 400, "item_id", "text"))
    got = [row for b in blocks for row in b]
    assert len(got) == len(set(got)) and {i for i, _ in got} == {None, "x"} and ("x", "a a a") in got

    def windows(texts):
        return {tuple(w[i : i + 10]) for w in map(str.split, texts) for i in range(len(w) - 9)}

    assert windows(w for i, w in got if i is None) == windows(texts)
    sizes = [sum(len(w.split()) for _, w in b) for b in blocks]
    assert len(blocks) > 3 and max(sizes) <= 1200
    assert list(decontam.item_blocks(bench.where("item_id in ('y', 'z')"), 10, 400, "item_id", "text")) == []


JOB_ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from wardline.session import get_session
from wardline.llm import decontam
spark = get_session("local[2]", shuffle_partitions=2)
words = " ".join(f"w{{i}}" for i in range(12))
docs = spark.createDataFrame([(1, "before " + words + " after"), (2, "clean text")], "doc_id long, text string")
bench = spark.createDataFrame([("a", words)], "item_id string, text string")
print("hits", [r.n_hit for r in decontam.contamination_report(docs, bench).orderBy("doc_id").collect()])
print("texts", [r.text for r in decontam.decontaminate(docs, bench, max_coverage=0.9).orderBy("doc_id").collect()])
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "job.py"
    script.write_text(JOB_ELSEWHERE.format(repo=repo))
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "hits [12, 0]" in run.stdout and "texts ['before  after', 'clean text']" in run.stdout, run.stderr[-2000:]
