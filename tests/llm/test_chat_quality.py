import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_samples import EDGE_TEXTS, docs_of, random_words
from pyspark.sql import functions as F
from wardline.llm import chat, quality

TURNS = "conv_id long, turn long, role string, text string"


def messages(spark, rows):
    return spark.createDataFrame(rows, TURNS)


def some_turns():
    rng = random.Random(4)
    bits = ["ok", "\\", "<|", "|>", "</s>", "[INST]", "<", "|", ">", "é😀", "\n", chat.TURN, chat.BODY, chat.END, "<image:0>", "<\\|"]
    return [(c, t, rng.choice(["user", "assistant", "system", None, "a<|b"]), rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(12)))]))
            for c in [*range(20), None] for t in range(rng.randrange(1, 7))]


def test_round_trip_and_digests(spark):
    rows = some_turns()
    got = {r["conv_id"]: r for r in chat.conversation_report(messages(spark, rows)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own).encode()).hexdigest()
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    f = chat.format_turns(messages(spark, rows)).collect()
    for r in f:
        assert chat.read_back(r["segment"]) == (r["role"] or "", r["text"] or "")
        body = r["segment"].removeprefix(chat.TURN).removesuffix(chat.END).replace(chat.BODY, "", 1)
        assert not any(c in body for c in chat.CONTROL)
        assert r["attachments"] == []


@given(st.lists(st.sampled_from(["\\", "<", "|", ">", "[INST]", "</s>", "a", "é"]), max_size=12).map("".join))
def test_unescape(text):
    out = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        out = out.replace(c, c[0] + "\\" + c[1:])
    assert chat.unescape(out) == text


def test_typed_parts(spark):
    rows = [(1, 0, "user", None, [("text", "look <image:0> ", None, None, None, None, None), ("image", None, "u/1.png", 280, 57, None, None),
                                  (None, "and", None, None, None, None, None), ("audio", None, "a.wav", None, None, 2.5, None),
                                  ("document", None, "d.pdf", None, None, None, 3), ("other", "x", None, None, None, None, None), None]),
            (1, 1, "assistant", None, None)]
    df = spark.createDataFrame(rows, f"{TURNS}, parts array<{chat.PART}>")
    a, b = chat.format_turns(df, parts="parts").orderBy("turn").collect()
    assert chat.read_back(a["segment"])[1] == "look <image:0> <image:0>and<audio:1><document:2>x"
    assert "<\\image:0> <image:0>and" in a["segment"]
    assert [(x["number"], x["type"], x["ref"], x["tokens"]) for x in a["attachments"]] == [(0, "image", "u/1.png", 30), (1, "audio", "a.wav", 32), (2, "document", "d.pdf", 768)]
    for x in a["attachments"]:
        assert a["segment"][x["start"] :].startswith(f"<{x['type']}:{x['number']}>")
    assert b["loss_start"] == b["loss_end"] and b["attachments"] == []


def test_chat_edge_cases(spark):
    assert chat.conversation_report(messages(spark, [])).count() == 0
    long = [(1, t, "assistant", "x" * 1000) for t in range(3000)]
    r = chat.conversation_report(messages(spark, long + [(2, None, "user", "a"), (2, None, "user", "a")])).collect()
    assert sorted((x["n_turns"], x["loss_chars"]) for x in r) == [(2, 0), (3000, 3_000_000)]
    extra = messages(spark, some_turns()).withColumn("segment", F.lit("own")).withColumn("loss_start", F.lit("own"))
    assert chat.conversation_report(extra).count() == 21


def brute(text):
    t = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in t).split(" ") if w]
    grams = {}
    for i in range(len(words) - 7):
        grams.setdefault(tuple(words[i : i + 8]), []).append(i)
    rep = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in t.split("\n") if any(c not in "\t\n\x0b\x0c\r " for c in x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep)


def quality_texts():
    rng = random.Random(6)
    for i in range(120):
        w = random_words(i, rng.randrange(80), rng.choice([2, 30, 500]))
        if i % 3 == 0:
            w += w[: rng.randrange(20)]
        yield rng.choice([" ", "\n", " # ", "\t| "]).join(w)
    yield "a b c d e f g h " * 3
    yield "line\nline\n \nline\r\nother"


@pytest.mark.parametrize("which", ["random", "edge"])
def test_measures_equal_brute_force(spark, edge, which):
    texts = list(quality_texts()) if which == "random" else EDGE_TEXTS
    rows = quality.quality_report(docs_of(spark, texts) if which == "random" else edge).collect()
    got = sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    want = []
    for t in texts:
        m = brute(t)
        want.append((*m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert got == sorted(want)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_thresholds_adapt_and_clean_rows_stay(spark, empty):
    rng = random.Random(7)
    texts, ids = [], []
    for i in range(300):
        w = random_words(i, 60, 4000)
        if i % 50 == 0:
            w = [x + "$$$" for x in w]
        elif i % 3 == 0:
            w = [x + ("#" if rng.random() < 0.4 else "") for x in w]  # a source of code: many symbols are usual there
        texts.append(" ".join(w))
    df = docs_of(spark, texts).withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "code").otherwise("web"))
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(df).collect()}
    assert not any(kept[i] for i in range(0, 300, 50))
    assert sum(kept.values()) == 294
    assert quality.quality_report(empty).count() == 0


@pytest.mark.parametrize("dirty", [0, 5, 15, 30])
def test_dirty_rows_go_whatever_their_share(spark, dirty):
    texts, bad = [], set()
    for i in range(400):
        w = random_words(i, 60, 4000)
        if i % 100 < dirty:
            bad.add(i)
            w = [[x + "$$" for x in w], [x + "longsuffix" for x in w]][i % 2]
        texts.append(" ".join(w))
    df = docs_of(spark, texts).withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") < 200, "a").otherwise("b"))
    kept = {r["doc_id"] for r in quality.quality_report(df).collect() if r["kept"]}
    assert kept == set(range(400)) - bad


def test_a_group_may_be_stricter_than_another(spark):
    # many symbols are usual in "code", and the same share of them fails in "web"
    texts = [" ".join(x + ("##" if i % 2 or i >= 300 else "") for x in random_words(i, 60, 4000)) for i in range(320)]
    df = docs_of(spark, texts).withColumn("lang", F.lit("en")).withColumn(
        "source", F.when((F.col("doc_id") % 2 == 1) & (F.col("doc_id") < 300), "code").otherwise("web"))
    kept = {r["doc_id"] for r in quality.quality_report(df).collect() if r["kept"]}
    assert kept == set(range(300))
    limits = {r["source"]: r["symbol_ratio"] for r in quality.thresholds(quality.ratios(quality.measures(df.drop("n_chars")))).collect()}
    assert limits["web"] < 0.2 < limits["code"]


def test_sketches_merge_and_bound_the_error(spark):
    rng = random.Random(8)
    xs = [rng.lognormvariate(0, 1) for _ in range(5000)]
    df = spark.createDataFrame([("a" if i % 2 else "b", x) for i, x in enumerate(xs)], "k string, x double")
    merged = quality.merged(quality.sketch(df, ["k"], ["x"]), [])
    whole = quality.sketch(df.repartition(5), [], ["x"])
    assert sorted(merged.collect()) == sorted(whole.select(*merged.columns).collect())
    r = quality.sketch_quantiles(merged, [], {"mid": 0.5, "top": 0.9}).collect()[0]
    xs.sort()
    for name, q in (("mid", 0.5), ("top", 0.9)):
        assert 1 <= r[name] / xs[int(q * 5000) - 1] <= quality.GROWTH + 1e-9
