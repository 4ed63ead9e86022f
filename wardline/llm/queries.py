"""Queries of the training-data operators and, where SQL expresses them, their
DuckDB texts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (
    audit, chat, decontam, jaccard, lexical, mixing, pii, quality, secrets, substrings, syncmers, tokens, toxicity,
)
from wardline.llm.common import table

#: the tokenizer file of the token counts, unless WARDLINE_TOKENIZER names another
TOKENIZER = "piece_bpe_32k.model"


def tokenizer_bytes() -> bytes:
    path = os.environ.get("WARDLINE_TOKENIZER")
    if not path:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, "rb") as f:
        return f.read()


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_bytes())


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_report(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat.conversation_report(rows.unionByName(probe))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op11_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_report(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.divergence(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_pii, op2_decontamination, op3_token_counts, op4_secrets, op5_jaccard_join, op6_toxicity, op7_substring_dedup,
    op8_mixing, op9_chat_format, op10_quality_rules, op11_syncmers, op12_source_divergence, op13_lexical_search)}

FOLDED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{FOLDED}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{FOLDED}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT doc_id, dw.i, dw.k, item_id FROM dw JOIN iw USING (k, g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS l FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(it.l, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""

BLANK = r"[^\x20\x09-\x0D]+"

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{BLANK}') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM g JOIN r USING (h)),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT p.doc_id, count(gone.p) AS n, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY p.p) AS kept
      FROM p LEFT JOIN gone USING (doc_id, p) GROUP BY p.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{FOLDED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c * 5 >= (x.n + y.n - c) * 4),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS class_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM d
"""

_RULES = list(quality.RULES.items())
_LOG = f"ln({quality.GROWTH})"


def _fence(keys: str) -> str:
    """Fences of one level, from quantiles of the buckets."""
    group = f"{keys}, measure" if keys else "measure"
    at = lambda q: f"min(CASE WHEN upto >= ceil({q} * rows) THEN edge END)"
    slack, top = ("CASE measure " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in _RULES) + " END" for i in (0, 1))
    return f"""
      SELECT {group}, max(rows) AS rows, least({at(0.5)} + {quality.SPREAD} * ({at(0.5)} - {at(quality.LOWER)}) + {slack}, {top}) AS f
      FROM (SELECT {group}, CASE WHEN bucket = -1000 THEN 0.0 ELSE pow({quality.GROWTH}, bucket) END AS edge,
                   sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {group}) AS rows
            FROM (SELECT {group}, bucket, sum(n) AS n FROM sk GROUP BY {group}, bucket))
      GROUP BY {group}"""


_W = float(quality.PRIOR_ROWS)
QUALITY = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLANK}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines
      FROM d LEFT JOIN rep USING (doc_id)),
r AS (SELECT *, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0.0 END AS symbol_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
             CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_ratio,
             CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS word_length FROM m),
v AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, '{c}' AS measure, {c} AS x FROM r" for c, _ in _RULES)}),
sk AS (SELECT lang, source, measure, CASE WHEN x <= 1e-6 THEN -1000 ELSE CAST(ceil(ln(x) / {_LOG}) AS INT) END AS bucket, count(*) AS n FROM v GROUP BY ALL),
fine AS ({_fence("lang, source")}), mid AS ({_fence("lang")}), coarse AS ({_fence("")}),
bad AS (SELECT DISTINCT v.doc_id FROM v
        JOIN fine ON fine.lang IS NOT DISTINCT FROM v.lang AND fine.source IS NOT DISTINCT FROM v.source AND fine.measure = v.measure
        JOIN mid ON mid.lang IS NOT DISTINCT FROM v.lang AND mid.measure = v.measure JOIN coarse ON coarse.measure = v.measure
        WHERE v.x > (fine.rows * fine.f + {_W} * ((mid.rows * mid.f + {_W} * coarse.f) / (mid.rows + {_W}))) / (fine.rows + {_W}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM r
"""

LETTERS = r"[^\x00-\x60\x7B-\x7F]+"  # after folding
_SHARE = f"1 + ({audit.SCALE} * ({{n}} + {audit.PRIOR})::HUGEINT) // ({{total}} + {audit.PRIOR} * terms)"

DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{LETTERS}') AS w FROM documents),
tf AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS c FROM tf GROUP BY ALL HAVING count(*) >= {audit.LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS terms, sum(c) AS total FROM k GROUP BY lang),
own AS (SELECT lang, source, term, sum(n) AS n FROM tf SEMI JOIN k USING (lang, term) GROUP BY ALL),
m AS (SELECT g.lang, g.source, k.term, coalesce(own.n, 0) AS n, k.c, v.terms, v.total AS lang_total,
             sum(coalesce(own.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN own USING (lang, source, term)),
p AS (SELECT lang, source, term, n, {_SHARE.format(n="n", total="total")} AS p, {_SHARE.format(n="c", total="lang_total")} AS q FROM m),
gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(gap.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source
         UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= {audit.TOP}
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{FOLDED}') AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{FOLDED}')) AS term FROM benchmark),
tf AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM tf SEMI JOIN q USING (term) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n FROM s) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p GROUP BY term),
score AS (SELECT item_id, r, doc_id, CAST(sum(w * (({lexical.SCALE} * tf) // (1000 * tf + 20 * (100 - {lexical.SHARE} + (({lexical.SHARE} * p.n * s.n) // s.l))))) AS BIGINT) AS score
          FROM q JOIN p USING (term) JOIN df USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0) WHERE rank <= 50
"""

LLM_ORACLE = {
    "op2_decontamination": DECONTAMINATION,
    "op5_jaccard_join": JACCARD,
    "op7_substring_dedup": SUBSTRINGS,
    "op8_mixing": mixing.ORACLE,
    "op9_chat_format": chat.ORACLE,
    "op10_quality_rules": QUALITY,
    "op12_source_divergence": DIVERGENCE,
    "op13_lexical_search": SEARCH,
}
