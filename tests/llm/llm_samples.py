"""Small documents and edge cases for the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None, extra=False):
    """Documents with the given texts; ``extra`` adds columns with names that
    the operators use for their own."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if k % 2 else None, f"s{k % 3}" if k % 5 else None, None if t is None else len(t))
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for name in ("spans", "rules", "score", "kept", "n_words", "class_id", "_text", "_tox", "_cut", "_source", "_row", "copy_no"):
            df = df.withColumn(name, F.lit("own"))
    return df


EDGE_TEXTS = [None, "", " ", "\n\n", "a", "a b c", "same words here again", "same words here again", "é" * 5000,
              "word " * 30000, "x" * 100000, "　  z", "1.2.3.4 " * 20, "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " p@q.rs"]
EDGE_IDS = [0, 1, None, 3, 4, 5, 6, 6, 8, 9, 10, None, 12, 13]


def random_words(seed, n, vocab=60):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]
