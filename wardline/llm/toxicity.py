"""Toxic sentences by multiple-instance learning (operator 6).

Only documents carry labels.  A sentence's probability is a logistic function
of hashed features of its words (the folded word and its first four, five and
six bytes), a document's is the noisy-or of its sentences,
``1 - (1 - leak) * prod(1 - p)``, and the weights are fitted on document labels
through that product, so the fitted model also tells which sentences offend.
A sentence without a telling feature has probability 0, and the base rate is
one leak per document.  It follows the logarithm of the number of sentences up
to a cap far below one half: a text does not become toxic by its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import packed, small_batches, stored, text_or_empty, unpacked, worker_cache
from wardline.llm.textops import FOLD, FOLDED_WORDS, find_words, hash_words, join_texts, slices

#: weights by hashed feature: a table of fixed size, 16 MB
BITS = 22
#: labelled rows of each class that the fit reads at most, of any length
MAX_PER_CLASS = 3000
#: a feature counts if it occurs in so many documents of the sample, and in
#: toxic ones more often than in others by so many standard errors
MIN_DOCS, MIN_Z = 3, 3.0
STEPS, RATE, DECAY = 120, 0.15, 1e-5
#: in a score, a sentence's probability p counts as p * p^2 / (p^2 + DOUBT^2):
#: thousands of hardly suspicious sentences are no toxic one
DOUBT = 0.1
#: highest logit of a document's leak: one in ten
MOST_LEAK = -2.2

_IS_END = np.zeros(256, bool)
_IS_END[[ord(c) for c in ".!?\n"]] = True


def sentences(texts: list[bytes]):
    """Features and bounds of the sentences of several texts.

    Returns word features (words x 4), the sentence of each word, the text of
    each sentence and the byte range of each sentence in its text.  A sentence
    ends after ``. ! ?`` or a newline; one without words is left out, but a
    text without words counts as one sentence without features.
    """
    buf, at = join_texts(texts)
    buf = FOLD[buf]
    starts, ends = find_words(buf, FOLDED_WORDS)
    stops = np.flatnonzero(_IS_END[buf[: at[-1]]])
    text_of = np.searchsorted(at, starts, "right") - 1
    # a sentence is a text and the number of stops before the word
    part = np.searchsorted(stops, starts)
    new = np.ones(len(starts), bool)
    new[1:] = (part[1:] != part[:-1]) | (text_of[1:] != text_of[:-1])
    sent = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    doc = text_of[first]
    lo = starts[first] - at[doc]
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    hi = ends[last] - at[doc]
    size = ends - starts
    feats = [hash_words(buf, starts, ends, 1)]
    for k in (4, 5, 6):
        feats.append(hash_words(buf, starts, starts + np.minimum(size, k), k))
    feats = (np.stack(feats, axis=1) >> np.uint64(64 - BITS)).astype(np.int64) if len(starts) else np.zeros((0, 4), np.int64)
    empty = np.setdiff1d(np.arange(len(texts)), doc)
    doc = np.concatenate([doc, empty])
    lo, hi = (np.concatenate([x, np.zeros(len(empty), x.dtype)]) for x in (lo, hi))
    return feats, sent, doc, lo, hi


def softplus(z):
    return np.logaddexp(0.0, z)


def count_features(sample: DataFrame) -> DataFrame:
    """``feature, n0, n1``: documents of each class that hold a feature, from
    rows of ``_y, _text``."""

    def count(batches):
        holds = np.zeros((2, 1 << BITS), np.int32)
        for b in batches:
            y = b.column("_y").to_numpy().astype(np.int64)
            for first, part in slices(b.column("_text")):
                f, s, d, _, _ = sentences(part)
                pairs = np.sort((d[s][:, None] * (1 << BITS) + f).ravel())
                in_doc, of = np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]], 1 << BITS)
                for k in (0, 1):
                    np.add.at(holds[k], of[y[first + in_doc] == k], 1)
        at = np.flatnonzero(holds.any(axis=0)).astype(np.int32)
        for lo in range(0, len(at), 1 << 16):
            own = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(holds[0, own]), pa.array(holds[1, own])], ["feature", "n0", "n1"])

    each = small_batches(sample).select("_y", "_text").mapInArrow(count, "feature int, n0 int, n1 int")
    return each.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def telling_features(counts: DataFrame, n0: int, n1: int) -> np.ndarray:
    """Sorted numbers of the features that speak for the label."""
    h0, h1 = F.col("n0"), F.col("n1")
    pooled = F.least(F.greatest((h0 + h1) / (n0 + n1), F.lit(1e-9)), F.lit(1 - 1e-9))
    used = counts.where((h0 + h1 >= MIN_DOCS) & (h1 * n0 > h0 * n1)
                        & (h1 / n1 - h0 / n0 >= MIN_Z * F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))))
    return np.sort(used.select("feature").toArrow().column(0).to_numpy().astype(np.int32))


def bags(sample: DataFrame, used: np.ndarray) -> DataFrame:
    """``_y, _id, feats, sent, plain`` of each row: the places in ``used`` of
    its words' features, the sentence of each, and the number of sentences
    without any.  The latter have probability 0, so a long text is small and yet
    whole."""
    sent_used = sample.sparkSession.sparkContext.broadcast(used)

    @F.arrow_udf("struct<feats:binary,sent:binary,plain:long>")
    def bag(texts: pa.Array) -> pa.Array:
        number = np.full(1 << BITS, -1, np.int32)
        number[sent_used.value] = np.arange(len(sent_used.value))
        out = []
        for _, part in slices(texts):
            f, s, d, _, _ = sentences(part)
            f, s = number[f].ravel(), np.repeat(s, f.shape[1])
            f, s = f[f >= 0], s[f >= 0]
            of = d[s]  # words come text by text, so the places of a text are a run
            at = np.searchsorted(of, np.arange(len(part) + 1))
            n_sent = np.bincount(d, minlength=len(part))
            for i in range(len(part)):
                own, at_sent = f[at[i] : at[i + 1]], s[at[i] : at[i + 1]]
                at_sent = np.cumsum(np.append(0, at_sent[1:] != at_sent[:-1]))[: len(own)].astype(np.int32)
                full = int(at_sent[-1]) + 1 if len(own) else 0
                out.append({"feats": own.tobytes(), "sent": at_sent.tobytes(), "plain": int(n_sent[i]) - full})
        return pa.array(out, pa.struct([("feats", pa.binary()), ("sent", pa.binary()), ("plain", pa.int64())]))

    return small_batches(sample).select("_y", "_id", bag("_text").alias("_b")).select("_y", "_id", "_b.*")


def loss_and_gradient(w: np.ndarray, feats: np.ndarray, sent: np.ndarray, doc: np.ndarray, size: np.ndarray, labels: np.ndarray,
                      weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted log-loss of the noisy-or, and its gradient.

    ``w``: the weight of each used feature, the intercept of a sentence, the
    leak of a document as a logit and its slope by ``size``, the logarithm of
    one plus the sentences; ``feats`` and ``sent``: the features that occur and
    their sentences; ``doc``: the document of each such sentence."""
    z = w[-3] + np.bincount(sent, weights=w[feats], minlength=len(doc))
    leak = w[-2] + w[-1] * size
    total = np.maximum(np.bincount(doc, weights=softplus(z), minlength=len(labels)) + softplus(np.minimum(leak, MOST_LEAK)), 1e-9)
    part = np.where(labels == 1, -np.log(-np.expm1(-total)), total)
    slope = weight * np.where(labels == 1, -1.0 / np.expm1(np.minimum(total, 50)), 1.0)
    by_sent = slope[doc] / (1 + np.exp(-np.clip(z, -50, 50)))
    by_doc = np.where(leak < MOST_LEAK, slope / (1 + np.exp(-np.clip(leak, -50, 50))), 0.0)
    g = np.concatenate([np.bincount(feats, weights=by_sent[sent], minlength=len(w) - 3), [by_sent.sum(), by_doc.sum(), by_doc @ size]])
    g[:-3] += DECAY * w[:-3]
    return float((weight * part).sum() + DECAY / 2 * (w[:-3] ** 2).sum()), g


def fit(rows: pa.Table, labels: np.ndarray, weight: np.ndarray, n_used: int) -> tuple[np.ndarray, float, list[float]]:
    """Weights of the used features, the intercept, the leak and its slope:
    full-batch Adam on the rows of ``bags``."""
    feats, sent, doc = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    n_sent, size = 0, rows.column("plain").to_numpy().astype(np.float64)
    for i, (f, s) in enumerate(zip(rows.column("feats"), rows.column("sent"), strict=True)):
        s = np.frombuffer(s.as_py(), np.int32)
        feats.append(np.frombuffer(f.as_py(), np.int32))
        sent.append(s + np.int32(n_sent))
        k = int(s[-1]) + 1 if len(s) else 0
        doc.append(np.full(k, i, np.int32))
        n_sent += k
        size[i] += k
    feats, sent, doc = (np.concatenate(x) for x in (feats, sent, doc))
    size = np.log1p(size)
    w = np.zeros(n_used + 3)
    w[-3:-1] = -5.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = weight / weight.sum()
    for t in range(1, STEPS + 1):
        _, g = loss_and_gradient(w, feats, sent, doc, size, labels, weight)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w[:-3].astype(np.float32), float(w[-3]), [float(w[-2]), float(w[-1])]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[bytes, bytes, float, float, float]:
    """Fit on at most ``MAX_PER_CLASS`` labelled rows of each class.

    Rows are taken in the order of a hash of the id, so the sample is the same
    in every run; a text's length plays no part, and all of its sentences count.
    A repeated label row counts once (the larger label), a null id or label not
    at all; of several texts with one id the least one is read.  Features are counted and bags made row by row in many tasks; one
    task fits the bounded number of bags.
    """
    label = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("_y")))
    counts = {r["_y"]: r["count"] for r in label.groupBy("_y").count().collect()}
    picked = None
    for y in (0, 1):
        top = label.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(MAX_PER_CLASS)
        picked = top if picked is None else picked.unionAll(top)
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    sample = stored(texts.join(F.broadcast(picked), "_id").groupBy("_y", "_id").agg(F.min("_text").alias("_text")), "sample")
    share = [counts.get(y, 0) / max(1, min(counts.get(y, 0), MAX_PER_CLASS)) for y in (0, 1)]
    have = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    if len(have) < 2:
        return b"", b"", -5.0, -5.0, 0.0
    used = telling_features(count_features(sample), have[0], have[1])

    def run(batches):
        held = pa.Table.from_batches(list(batches)).sort_by([("_y", "ascending"), ("_id", "ascending")])  # the batches come in any order
        y = held.column("_y").to_numpy().astype(np.int64)
        w, b0, leak = fit(held, y, np.array(share)[y], len(used))
        yield pa.RecordBatch.from_pydict({"weight": [w.tobytes()], "base": [b0], "leak": [leak]})

    row = bags(sample, used).repartition(1).mapInArrow(run, "weight binary, base double, leak array<double>").first()
    return used.tobytes(), bytes(row["weight"]), row["base"], *row["leak"]


def score_documents(docs: DataFrame, model: tuple[bytes, bytes, float, float, float], text_col: str = "text",
                    out: str = "_tox", sentence_limit: float = 0.5) -> DataFrame:
    """``docs`` with ``out``: the document's score and its offending sentences
    (start and end in code points, probability), those of ``sentence_limit`` or
    more.

    A text without a telling feature, also a null or empty one, scores the
    leak.  Rows are scored alone; an empty table stays empty; an input column named ``out`` is
    replaced, all others are kept.
    """
    sent_model = docs.sparkSession.sparkContext.broadcast(model)
    key = hash(model)
    kind = pa.struct([("score", pa.float64()),
                      ("sentences", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])

    @F.arrow_udf("struct<score:double,sentences:array<struct<start:int,end:int,score:double>>>")
    def score(texts: pa.Array) -> pa.Array:
        cache = worker_cache()
        if cache.get("tox_key") != key:
            used, weight, base, *leak = sent_model.value
            w, telling = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, bool)
            w[np.frombuffer(used, np.int32)] = np.frombuffer(weight, np.float32)
            telling[np.frombuffer(used, np.int32)] = True
            cache["tox_key"], cache["tox"] = key, (w, telling, base, leak)
        w, telling, base, leak = cache["tox"]
        rows = []
        for _, part in slices(texts):
            feats, sent, doc, lo, hi = sentences(part)
            z = base + np.bincount(sent, weights=w[feats].sum(axis=1, dtype=np.float64), minlength=len(doc))
            tells = np.bincount(sent, weights=telling[feats].any(axis=1), minlength=len(doc)) > 0
            p = np.where(tells, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)
            counted = np.minimum(p * p * p / (p * p + DOUBT * DOUBT), 1 - 1e-15)
            size = np.log1p(np.bincount(doc, minlength=len(part)))
            scores = -np.expm1(-softplus(np.minimum(leak[0] + leak[1] * size, MOST_LEAK)) + np.bincount(doc, weights=np.log1p(-counted), minlength=len(part)))
            found = [[] for _ in part]
            for i in np.flatnonzero(p >= sentence_limit):
                d = doc[i]
                a = len(part[d][: lo[i]].decode("utf-8", "replace"))
                found[d].append({"start": a, "end": a + len(part[d][lo[i] : hi[i]].decode("utf-8", "replace")), "score": float(p[i])})
            rows += [{"score": float(s), "sentences": f} for s, f in zip(scores, found, strict=True)]
        return pa.array(rows, kind)

    return small_batches(docs).withColumn(out, score(text_or_empty(text_col)))


def held_out(id_col: str = "doc_id"):
    """Rows never trained on: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Score of every row from a model fitted outside the held-out fifth.

    A null text is empty, a null id is not held out, each row with a repeated
    id is scored, an empty table gives an empty result; labels only train."""
    model = train(docs, labels.where(~held_out(id_col)), id_col)
    s = score_documents(docs.select(F.col(id_col), F.col("text")), model)
    return s.select(id_col, held_out(id_col).alias("held_out"), F.col("_tox.score").alias("score"),
                    F.when(F.col("_tox.score") >= 0.5, 1).otherwise(0).alias("predicted"),
                    F.size("_tox.sentences").cast("long").alias("n_sentences"),
                    F.array_join(F.transform("_tox.sentences", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("sentences"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score under ``limit``, unchanged, whatever their
    columns are called.  A null or empty text stays unless the leak is above
    the limit; without labels of both classes every row stays."""
    model = train(docs, labels.where(~held_out()))
    rows = packed(docs).withColumn("_text", F.col("_row")["text"])
    return unpacked(score_documents(rows, model, "_text").where(F.col("_tox")["score"] < limit), docs.columns)
