"""Secret scanning with a trigram index (operator 4, built-in functions only).

Every rule's pattern is analysed into a Boolean query over trigrams: at least
one conjunction of trigrams must occur in any text that matches.  An inverted
index lists, for each trigram that some rule needs, the texts that hold it;
intersecting the lists of a conjunction gives the candidates, and only
these are searched with the rule's pattern.  A rule without mandatory trigrams
searches every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import packed, sha, stored, unpacked
from wardline.llm.quality import let


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and Python read alike; ``group`` of a match must
    have ``least`` characters or more, else the match is dropped."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", "[0-9a-f]{32,}", 0, 32, True),  # the runs of [0-9a-f]+ that are long enough
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_host", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)

#: alternatives that the analysis keeps apart; beyond them it asks for less
MOST_ALTERNATIVES = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Conjunctions of lower-case trigrams, one of which every match holds;
    none if the pattern has no mandatory trigram."""
    parser = re._parser

    def add(alts, char):
        out = set()
        for grams, run in alts:
            run = (run + char)[-3:]
            out.add((grams | {run} if len(run) == 3 else grams, run))
        return out

    def cut(alts):
        return {(grams, "") for grams, _ in alts}

    def bounded(alts):
        if len(alts) <= MOST_ALTERNATIVES:
            return alts
        alts = cut(alts)
        return alts if len(alts) <= MOST_ALTERNATIVES else {(frozenset.intersection(*[g for g, _ in alts]), "")}

    def one_of(op, arg):
        """The characters of a small class, else None."""
        if op == parser.LITERAL:
            return {chr(arg).lower()}
        if op != parser.IN:
            return None
        out = set()
        for kind, x in arg:
            if kind == parser.LITERAL:
                out.add(chr(x).lower())
            elif kind == parser.RANGE and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 6 else None

    def walk(seq, alts):
        for op, arg in seq:
            chars = one_of(op, arg)
            if chars is not None:
                alts = set().union(*[add(alts, c) for c in chars])
            elif op == parser.SUBPATTERN:
                alts = walk(arg[3], alts)
            elif op == parser.BRANCH:
                alts = set().union(*[walk(x, alts) for x in arg[1]])
            elif op == parser.MAX_REPEAT or op == parser.MIN_REPEAT:
                least, most, sub = arg
                if least == 0:
                    alts = alts | walk(sub, alts) if most == 1 else cut(alts)
                else:
                    for _ in range(min(least, 8)):
                        alts = bounded(walk(sub, alts))
                    alts = alts if least == most <= 8 else cut(alts)
            elif op != parser.AT:
                alts = cut(alts)
            alts = bounded(alts)
        return alts

    found = {grams for grams, _ in walk(parser.parse(pattern), {(frozenset(), "")})}
    least = [g for g in found if not any(o < g for o in found)]
    return [] if any(not g for g in least) else sorted(least, key=sorted)


def text_key(id_col: str, text_col: str) -> list[Column]:
    """What tells the rows of the index apart: the id and a hash of the text."""
    return [F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash")]


def postings(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """Inverted index: ``trigram, _id, _hash`` of each trigram in each text."""
    low = docs.select(*text_key(id_col, text_col), F.lower(text_col).alias("_low"))
    has = low.select("_id", "_hash", *[F.contains("_low", F.lit(t)).alias(f"_t{i}") for i, t in enumerate(trigrams)])
    listed = F.array_compact(F.array(*[F.when(F.col(f"_t{i}"), F.lit(t)) for i, t in enumerate(trigrams)]))
    return has.select("_id", "_hash", F.explode(listed).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``_id, _hash, rules``: texts in the intersection of the posting lists of
    some conjunction of each rule."""
    rows = [(rule, k, t, 1 << i, (1 << len(grams)) - 1) for rule, conj in queries.items()
            for k, grams in enumerate(conj) for i, t in enumerate(sorted(grams))]
    needs = index.sparkSession.createDataFrame(rows, "rule string, conj int, trigram string, bit long, need long")
    return (index.join(F.broadcast(needs), "trigram")  # a few rows per rule
            .groupBy("_id", "_hash", "rule", "conj", "need").agg(F.bit_or("bit").alias("bits")).where(F.col("bits") == F.col("need"))
            .groupBy("_id", "_hash").agg(F.collect_set("rule").alias("rules")))


SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string>>"


def running(widths: Column) -> Column:
    """Sums of the widths before each place, in blocks of 256."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + x)
    block = lambda w, b: let(F.slice(w, b * 256 + 1, F.lit(256)), lambda own: let(
        total(F.slice(w, F.lit(1), b * 256)), lambda base: F.transform(own, lambda x, j: base + total(F.slice(own, F.lit(1), j)))))
    return let(widths, lambda w: F.flatten(F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / 256) - 1, F.lit(0)).cast("int")), lambda b: block(w, b))))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """All valid matches of a rule in code points: what lies between matches
    and the matches themselves, by their lengths, give the places."""
    hits = F.transform(F.arrays_zip(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
                                    F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("group")),
                       lambda x: F.struct(F.length(x["hit"]).alias("size"), F.length(x["group"]).alias("group")))
    between = F.transform(F.split(text, rule.pattern), F.length)
    placed = let(hits, lambda h: let(between, lambda g: let(
        running(F.zip_with(F.slice(g, F.lit(1), F.size(h)), h, lambda a, b: a + b["size"])),
        lambda before: F.transform(h, lambda x, i: F.struct(
            (F.get(before, i) + F.get(g, i)).alias("start"), F.lit(number).alias("kind_no"),
            (F.get(before, i) + F.get(g, i) + x["size"]).alias("end"), F.lit(rule.name).alias("kind"), x["group"].alias("group"))))))
    valid = F.transform(F.filter(placed, lambda x: x["group"] >= rule.least),
                        lambda x: F.struct(x["start"], x["kind_no"], x["end"], x["kind"]))
    return F.when(F.rlike(text, F.lit(rule.pattern)), valid).otherwise(F.array().cast(SPANS)).cast(SPANS)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
                 out: str = "_secrets") -> DataFrame:
    """``docs`` with ``out``: spans (start, end, kind) sorted by start, then by
    the order of the rules.

    A null or empty text has none; a row's result depends on its text alone,
    so repeated rows and ids repeat it; an empty table stays empty; all columns
    are kept, one named like ``out`` is replaced.
    """
    return unpacked(found_secrets(packed(docs), rules, id_col, text_col), [c for c in docs.columns if c != out], F.col("_secrets").alias(out))


def found_secrets(rows: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """Packed rows with their spans in ``_secrets``."""
    queries = {r.name: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for g in q for t in g})
    row = F.col("_row")
    text = F.coalesce(row[text_col].cast("string"), F.lit(""))
    if queries:
        index = postings(rows.select(row[id_col].alias("_id"), text.alias("_text")), trigrams, "_id", "_text")
        # stored, so that the planner knows its size: few candidates meet the texts where they lie
        found = stored(candidates(index, queries), "candidates")
        keyed = rows.withColumn("_key", F.xxhash64(text))
        rows = keyed.join(found, keyed["_row"][id_col].eqNullSafe(found["_id"]) & (keyed["_key"] == found["_hash"]), "left")
    parts = []
    for k, r in enumerate(rules):
        spans = rule_spans(text, r, k)
        parts.append(F.when(F.array_contains("rules", r.name), spans).otherwise(F.array().cast(SPANS)) if r.name in queries else spans)
    return rows.select("_row", F.sort_array(F.flatten(F.array(*parts))).alias("_secrets"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(kind: str):
    """Test of a span for its kind."""
    return lambda span: span["kind"] == kind


def secret_report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    s = scan_secrets(docs.select(id_col, "text"), id_col=id_col)
    base = [r.name for r in RULES if r.base]
    counts = [F.size(F.filter("_secrets", of_kind(k))).cast("long").alias(f"n_{k}") for k in base]
    return s.select(id_col, *counts, sha(span_list(F.filter("_secrets", lambda x: x["kind"].isin(*base)))).alias("base_sha256"),
                    span_list(F.col("_secrets")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[REDACTED]", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping ones by one);
    texts without a secret and all other columns stay as they are."""
    s = found_secrets(packed(docs), RULES, "doc_id", text_col)
    text = F.col("_row")[text_col]
    left = lambda acc, x: F.when(x["end"] <= acc["pos"], acc).otherwise(F.struct(
        x["end"].alias("pos"), F.concat(acc["out"], F.when(x["start"] >= acc["pos"], F.concat(
            F.substring(text, acc["pos"] + 1, x["start"] - acc["pos"]), F.lit(mark))).otherwise(F.lit(""))).alias("out")))
    clean = F.aggregate("_secrets", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), left,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return unpacked(s, docs.columns, **{text_col: F.when(F.size("_secrets") > 0, clean).otherwise(text)})
