"""Personal data by anchor expansion (operator 1).

One pass of an Aho-Corasick automaton over the text finds anchors: at-signs,
schemes, plus signs before a digit, digits and identifier cues.  A local
parser per anchor expands it to its boundaries and validates the result.
Every kind keeps the place up to which it has read, so each run of characters
is expanded once and matches of one kind never overlap.
"""

from __future__ import annotations

import re
import string

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import sha, small_batches, text_or_empty, values, worker_cache

#: the base kinds in their order, then the kinds that the method adds
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")

SCHEMES = ("http://", "https://", "ftp://")
IBAN_CUES = ("IBAN", "iban", "Iban")
ACCOUNT_CUES = ("account", "Account", "acct", "Acct", "Konto", "konto", "compte", "Compte", "cuenta", "Cuenta")

LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9])*")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL_REST = re.compile(r"[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
IBAN_REST = re.compile(r"[ :#.-]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
ACCOUNT_REST = re.compile(r"(?: ?(?:number|no|nr)\.?)?[ :#]{1,3}([0-9](?:-?[0-9]){5,19})(?![0-9])")

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    for d in string.digits:
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("plus", 2))
    for kind, cues in (("scheme", SCHEMES), ("iban", IBAN_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All validated spans (kind, start, end) in order of their anchors."""
    out = []
    read = dict.fromkeys(("at", "dots", "run", "plus", "scheme", "iban", "account"), 0)
    for last, (kind, size) in automaton.iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= read["dots"]:
                m = DOTTED.match(text, at)
                read["dots"] = m.end()
                parts = m.group().split(".")
                start = at
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    end = start + sum(map(len, four)) + 3
                    if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                        out.append(("ip", start, end))
                    start = end + 1
            if at >= read["run"]:
                m = DIGIT_RUN.match(text, at)
                read["run"] = m.end()
                if m.end() - at >= 16:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", at, m.end()))
        elif kind == "at":
            start = at
            while start > read["at"] and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1)
            if start < at and m:
                read["at"] = m.end()
                out.append(("email", start, m.end()))
        elif kind == "plus":
            m = PHONE.match(text, at) if at >= read["plus"] else None
            if m:
                read["plus"] = m.end()
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", at, m.end()))
        elif at >= read[kind]:
            m = (URL_REST if kind == "scheme" else IBAN_REST if kind == "iban" else ACCOUNT_REST).match(text, last + 1)
            if m:
                read[kind] = m.end()
                if kind == "scheme":
                    out.append(("url", at, m.end()))
                elif kind == "account":
                    out.append(("account", m.start(1), m.end()))
                elif mod97(m.group(1)):
                    out.append(("iban", m.start(1), m.end()))
    return out


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col``: personal data in each text, by kind and start.

    Offsets are code points, end exclusive.  A null or empty text has no
    spans; each row is handled alone, so repeated rows repeat their result and
    an empty table stays empty.  An input column named ``spans_col`` is
    replaced; all others are kept as they are.
    """

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        cache = worker_cache()
        automaton = cache.setdefault("pii", None) or cache.update(pii=anchors()) or cache["pii"]
        order = {k: i for i, k in enumerate(KINDS)}
        rows = []
        for t in values(texts):
            found = sorted(find_spans(t, automaton), key=lambda s: (order[s[0]], s[1]))
            rows.append([{"kind": k, "start": a, "end": b, "base": k in BASE_KINDS} for k, a, b in found])
        return pa.array(rows, _SPAN)

    return small_batches(docs).withColumn(spans_col, spans(text_or_empty(text_col)))


def of_kind(kind: str):
    """Test of a span for its kind."""
    return lambda span: span["kind"] == kind


def span_list(spans):
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per base kind, digest of the base spans and all spans, per row."""
    found = find_pii(docs.select(F.col(id_col), F.col(text_col)), text_col, "_spans")
    base = F.filter("_spans", lambda s: s["base"])
    counts = [F.size(F.filter("_spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select(id_col, *counts, sha(span_list(base)).alias("base_sha256"), span_list(F.col("_spans")).alias("spans"))
