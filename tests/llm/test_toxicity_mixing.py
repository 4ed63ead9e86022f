import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from llm_samples import EDGE_TEXTS, docs_of, random_words
from pyspark.sql import functions as F
from wardline.llm import mixing, textops, toxicity

BAD = ["vile", "foulmouth", "grimacing"]


def labelled(n, seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        s = [" ".join(random_words(seed * 1000 + 10 * i + k, 8, 300)) for k in range(rng.randrange(1, 6))]
        bad = rng.random() < 0.25
        if bad:
            k = rng.randrange(len(s))
            w = rng.choice(BAD) + rng.choice(["", "", "ly", "er"])
            s[k] = s[k] + " " + w + " " + " ".join(random_words(i, 2, 300))
        texts.append(". ".join(s) + ".")
        labels.append(int(bad))
    return texts, labels


def tables(spark, n=900):
    texts, y = labelled(n)
    return texts, y, docs_of(spark, texts), spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")


def test_held_out_accuracy_and_sentences(spark):
    texts, y, docs, labels = tables(spark)
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in range(len(y)) if zlib.crc32(str(i).encode()) % 5 == 0}
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in out]) > 0.95
    for r in out:  # offending sentences hold the planted word
        for span in filter(None, r["sentences"].split(",")):
            a, b = map(int, span.split(":"))
            if y[r["doc_id"]]:
                assert any(w in texts[r["doc_id"]][a:b] for w in BAD)


def test_labels_of_held_out_rows_are_not_used(spark):
    _, _, docs, labels = tables(spark, 300)
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, labels).collect()}
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, flipped).collect()}
    assert a == b


def test_long_clean_texts_are_fitted_and_stay(spark):
    texts, y = labelled(500)
    ids = list(range(500))
    for k in range(60):  # clean, 60,000 characters and more each
        ids.append(500 + k)
        texts.append(". ".join(" ".join(random_words(9_000_000 + 2000 * k + j, 8, 300)) for j in range(1800)) + ".")
        y.append(0)
    labels = spark.createDataFrame(list(zip(ids, y, strict=True)), "doc_id long, toxic int")
    out = [r for r in toxicity.toxicity_report(docs_of(spark, texts, ids), labels).collect() if r["held_out"]]
    assert sum(r["doc_id"] >= 500 for r in out) > 5
    assert not any(r["predicted"] for r in out if r["doc_id"] >= 500)
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in out]) > 0.95


def test_bags_hold_every_sentence(spark):
    words = [w.encode() for w in ("vile", "x")]
    feats = toxicity.sentences(words)[0]
    used = np.unique(feats[0]).astype(np.int32)
    docs = spark.createDataFrame([(0, 1, "a b. vile vile. c! vile d"), (0, 2, ""), (0, 3, "a. " * 50000 + "vile")], "_y int, _id int, _text string")
    got = {r["_id"]: r for r in toxicity.bags(docs, used).collect()}
    sents = {i: np.frombuffer(r["sent"], np.int32) for i, r in got.items()}
    assert [got[i]["plain"] for i in (1, 2, 3)] == [2, 1, 50000]
    assert [sorted(set(sents[i].tolist())) for i in (1, 2, 3)] == [[0, 1], [], [0]]
    assert [len(sents[i]) for i in (1, 2, 3)] == [12, 0, 4]


def test_noisy_or():
    texts = [b"one two. three four! five", b"", b"...", "é vile\nvile x".encode()]
    feats, sent, doc, lo, hi = toxicity.sentences(texts)
    assert doc.tolist() == [0, 0, 0, 3, 3, 1, 2] and feats.shape == (9, 4)
    assert [texts[d][a:b] for d, a, b in zip(doc, lo, hi, strict=True)][:3] == [b"one two", b"three four", b"five"]
    z = np.array([-1.0, 0.5])
    assert math.isclose(-math.expm1(-toxicity.softplus(z).sum()), 1 - (1 - 1 / (1 + math.e)) * (1 - 1 / (1 + math.exp(-0.5))))


def test_loss_and_gradient_like_plain():
    rng = np.random.default_rng(1)
    doc = np.array([0, 0, 1, 3, 3, 3])  # document 2 has no telling sentence
    sent, feats = np.array([0, 0, 1, 2, 3, 4, 5, 5]), np.array([0, 2, 1, 1, 3, 0, 2, 2])
    labels, weight, w = np.array([1, 0, 0, 1]), np.array([0.1, 0.4, 0.3, 0.2]), rng.normal(size=7)
    w[-2:] = -5.0, 1.0
    size = np.log1p([3, 2, 1, 40])  # the last one's leak is at the cap

    def plain(w):
        loss = 0.0
        for d in range(4):
            clean = 1 - 1 / (1 + math.exp(-min(w[-2] + w[-1] * size[d], toxicity.MOST_LEAK)))
            for s in np.flatnonzero(doc == d):
                clean *= 1 - 1 / (1 + math.exp(-w[-3] - sum(w[f] for f, at in zip(feats, sent, strict=True) if at == s)))
            loss -= weight[d] * math.log(1 - clean if labels[d] else clean)
        return loss + toxicity.DECAY / 2 * float(w[:-3] @ w[:-3])

    loss, g = toxicity.loss_and_gradient(w, feats, sent, doc, size, labels, weight)
    assert math.isclose(loss, plain(w))
    for k in range(7):
        step = np.eye(7)[k] * 1e-6
        assert math.isclose(g[k], (plain(w + step) - plain(w - step)) / 2e-6, rel_tol=1e-5, abs_tol=1e-9)


def test_scores_like_plain(spark):
    words = ["vile", "grim", "plain", "other"]
    number = {x: [int(f) for f in toxicity.sentences([x.encode()])[0][0]] for x in words}
    used = sorted({f for x in ("vile", "grim") for f in number[x]})
    weight = {f: 0.4 + 0.1 * i for i, f in enumerate(used)}
    model = (np.array(used, np.int32).tobytes(), np.array([weight[f] for f in used], np.float32).tobytes(), -2.5, -4.0, 0.3)
    texts = ["vile plain. other other! grim", "plain. other", "", None, "Vile VILE vile\nplain", "grim other. " * 400, "plain. " * 100_000]
    rows = toxicity.score_documents(docs_of(spark, texts), model).orderBy("doc_id").collect()
    for text, r in zip(texts, rows, strict=True):
        sents = [s for s in (text or "").replace("!", ".").replace("\n", ".").split(".") if s.strip()]
        clean = 1 - 1 / (1 + math.exp(-min(-4.0 + 0.3 * math.log(1 + max(len(sents), 1)), toxicity.MOST_LEAK)))
        for s in sents:
            own = [f for x in s.lower().split() for f in number[x] if f in weight]
            if own:
                p = 1 / (1 + math.exp(2.5 - sum(float(np.float32(weight[f])) for f in own)))
                clean *= 1 - p**3 / (p * p + toxicity.DOUBT**2)
        assert math.isclose(r["_tox"]["score"], 1 - clean, rel_tol=1e-6)


def test_very_long_clean_texts_stay_and_one_toxic_sentence_lifts_them(spark):
    _, _, docs, labels = tables(spark)
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    rng = random.Random(11)
    clean = ". ".join(" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(100_000))
    bad = clean + ". " + " ".join(["w1", BAD[0], "w2", BAD[0]])
    a, b = (r["_tox"]["score"] for r in toxicity.score_documents(docs_of(spark, [clean, bad]), model).orderBy("doc_id").collect())
    assert a < 0.5 < b and b - a > 0.3


def test_sample_of_a_repeated_id_is_the_same_in_every_order(spark):
    _, _, docs, labels = tables(spark, 200)
    twice = docs.unionByName(docs.withColumn("text", F.reverse("text")))
    assert toxicity.train(twice, labels) == toxicity.train(twice.orderBy(F.desc("text")).repartition(5), labels)


def test_toxicity_edge_cases(spark, edge, empty):
    _, _, _, labels = tables(spark, 50)
    rows = toxicity.toxicity_report(edge, labels.unionAll(labels)).collect()
    assert len(rows) == len(EDGE_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity_report(empty, labels).count() == 0
    for none in (labels.where("false"), labels.where("toxic = 1"), spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")):
        out = toxicity.drop_toxic(edge.withColumn("a.b", F.lit(1)), none).drop("a.b")
        assert out.columns == edge.columns and out.count() == len(EDGE_TEXTS)


def test_words_and_hashes():
    texts = ["Aé b\tc\n" + "long" * 30, "", " x "]
    buf, at = textops.join_texts([t.encode() for t in texts])
    s, e = textops.find_words(buf, textops.BLANK_WORDS)
    words = [bytes(buf[a:b]) for a, b in zip(s, e, strict=True)]
    assert words == [w.encode() for t in texts for w in t.split()]
    h = textops.hash_words(buf, s, e)
    assert len(set(h.tolist())) == len(set(words))
    rng = random.Random(1)
    many = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 20))) for _ in range(3000)]
    buf, _ = textops.join_texts(many)
    h = textops.hash_words(buf, *textops.find_words(buf, textops.BLANK_WORDS))
    assert len(set(h.tolist())) == len(set(many)) == len(set(zip(many, h.tolist(), strict=True)))
    assert textops.windows(h[:5], 8).size == 0 and textops.windows(h, 8).size == 2993
    parts = list(textops.slices(pa.array(["a" * 10, "b" * 10, None, "c" * 50]), 25))
    assert [p for _, part in parts for p in part] == [b"a" * 10, b"b" * 10, None, b"c" * 50] and len(parts) == 2


def poisson(u, rate):
    p = c = math.exp(-rate)
    k = 0
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def key_of(r, n=0):
    parts = [str(r.doc_id), r.text, "\x00" if r.lang is None else r.lang, r.source, str(r.n_chars)]
    return hashlib.md5("\x1f".join(parts).encode()).hexdigest() + f"|{n}"


def test_copies_are_the_inverse_of_the_distribution(spark):
    df = docs_of(spark, ["t"] * 400).withColumn("source", F.when(F.col("doc_id") < 300, "big").when(F.col("doc_id") < 399, "mid").otherwise("rare"))
    rows = mixing.mix_sources(df).collect()
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    n, keys = {"big": 300, "mid": 99}, {r.doc_id: key_of(r) for r in df.collect()}
    for i in range(399):
        rate = 400 / 3 / n["big" if i < 300 else "mid"]
        u = int(hashlib.md5(f"8|{keys[i]}|0".encode()).hexdigest()[:13], 16) / 2**52
        assert got.get(i, 0) == poisson(u, rate)
    # a rate of 133 is drawn in five parts of at most 32
    parts = [poisson(int(hashlib.md5(f"8|{keys[399]}|{k}".encode()).hexdigest()[:13], 16) / 2**52, 400 / 3 / 5) for k in range(5)]
    assert got[399] == sum(parts) and abs(got[399] - 133) < 60
    assert len({(r["doc_id"], r["copy_no"]) for r in rows}) == len(rows)


def test_rows_without_an_id_and_equal_rows_draw_for_themselves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 7)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "same", "en", "a", 4)] * 1000 + [(None, f"t{i}", "en", "a", 2) for i in range(500)]
    rows += [(5, "same", "en", "b", 4)] * 300 + [(6 + i, "same", "en", "c", 4) for i in range(1500)]
    df = spark.createDataFrame(rows, schema)
    out = mixing.mix_sources(df, {"a": 1.0, "b": 1.0, "c": 1.0}, total=1500).collect()
    n = {s: sum(r.source == s for r in out) for s in "abc"}
    assert all(abs(n[s] - 500) < 110 for s in "abc")
    same = [r for r in out if r.source == "a" and r.text == "same"]
    want = [poisson(int(hashlib.md5(f"8|{key_of_null(k)}|0".encode()).hexdigest()[:13], 16) / 2**52, 1 / 3) for k in range(1000)]
    assert len(same) == sum(want) and len({r.shuffle_key for r in out}) == len(out)
    again = mixing.mix_sources(df.repartition(5), {"a": 1.0, "b": 1.0, "c": 1.0}, total=1500).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def key_of_null(n):
    return hashlib.md5("\x1f".join(["\x00", "same", "en", "a", "4"]).encode()).hexdigest() + f"|{n}"


def test_target_weights_and_order(spark):
    df = docs_of(spark, ["t"] * 3000).withColumn("source", F.when(F.col("doc_id") % 3 > 0, "a").otherwise("b"))
    out = mixing.mix_sources(df, {"a": 1.0, "b": 3.0, "absent": 5.0}, total=6000)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["a"] - 1500) < 200 and abs(n["b"] - 4500) < 400
    again = mixing.mix_sources(df.repartition(7), {"a": 1.0, "b": 3.0, "absent": 5.0}, total=6000)
    key = lambda d: sorted((r["doc_id"], r["copy_no"], r["shuffle_key"]) for r in d.collect())
    assert key(out) == key(again)


def test_mixing_edge_cases(spark, edge, empty):
    out = mixing.mix_sources(edge)
    assert out.columns == [c for c in edge.columns if c != "copy_no"] + ["copy_no", "shuffle_key"]
    assert {r["source"] for r in out.collect()} <= {r["source"] for r in edge.collect()}
    dotted = docs_of(spark, ["x", None]).withColumn("a.b", F.array(F.lit(1))).withColumn("_key", F.lit("own"))
    assert mixing.mix_sources(dotted, total=50).columns == [*dotted.columns, "copy_no", "shuffle_key"]
    assert mixing.mix_sources(empty).count() == 0
