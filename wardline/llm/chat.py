"""Chat formatting with typed content parts (operator 9).

A message holds parts: text, image, audio or document.  A visitor (one column
expression per type) flattens them in order; what is not text becomes a
numbered placeholder, and its reference, place and token count are recorded.
Template of a turn::

    <|turn|>ROLE<|body|>BODY<|end|>

The escape character is a backslash: it is doubled, and inserted after the
first character of every control string, so no control string is left in a
text and dropping the escapes gives the text back.  The loss mask covers the
bodies of assistant turns, between ``<|body|>`` and ``<|end|>``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: strings that are control strings of this or of widely used templates
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<image:", "<audio:", "<document:")
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_sql(text: str) -> str:
    """The same in SQL."""
    out = f"replace(coalesce({text}, ''), '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


#: tokens that a part takes once expanded: an image by tiles of 14 x 14 merged
#: 2 x 2, audio by 12.5 frames a second, a document by 256 a page
VISITORS = {
    "image": lambda p: F.ceil(F.coalesce(p["width"], F.lit(0)) / 28) * F.ceil(F.coalesce(p["height"], F.lit(0)) / 28),
    "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * 12.5),
    "document": lambda p: F.coalesce(p["pages"], F.lit(0)) * 256,
}


def kind_of(p: Column) -> Column:
    """A null or unknown type is text."""
    return F.when(p["type"].isin(*VISITORS), p["type"]).otherwise(F.lit("text"))


def tokens_of(p: Column) -> Column:
    out = None
    for name, visit in VISITORS.items():
        out = F.when(p["type"] == name, visit(p)) if out is None else out.when(p["type"] == name, visit(p))
    return out.otherwise(F.lit(0)).cast("long")


def format_turns(messages: DataFrame, parts: str | None = None, text: str = "text", role: str = "role") -> DataFrame:
    """``messages`` with ``segment`` (the formatted turn), ``loss_start`` and
    ``loss_end`` (the mask inside the segment, equal when empty) and
    ``attachments`` (number, type, reference, offset of the placeholder in the
    segment, expanded tokens).

    ``parts`` names a column of typed parts; without it the text is the one
    part.  Null texts, roles and part lists are empty.  All rows are formatted
    alone; a conversation is its segments in turn order.
    """
    listed = F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")) if parts else F.array(
        F.struct(F.lit("text").alias("type"), F.col(text).alias("text"), *[F.lit(None).alias(x) for x in ("ref", "width", "height", "seconds", "pages")]).cast(PART))
    is_ref = lambda p: kind_of(p) != "text"
    df = messages.withColumn("_p", listed).withColumn("_p", F.transform("_p", lambda p: F.coalesce(p, F.lit(None).cast(PART))))
    # the number of attachments before each part gives the placeholder's number
    df = df.withColumn("_s", F.transform("_p", lambda p, i: F.struct(
        kind_of(p).alias("kind"), p["ref"].alias("ref"), tokens_of(p).alias("tokens"),
        F.size(F.filter(F.slice(F.col("_p"), F.lit(1), i), is_ref)).alias("number"),
        F.when(is_ref(p), F.lit("")).otherwise(escape(p["text"])).alias("body"))))
    df = df.withColumn("_s", F.transform("_s", lambda s: F.when(s["kind"] == "text", s).otherwise(
        s.withField("body", F.concat(F.lit("<"), s["kind"], F.lit(":"), s["number"].cast("string"), F.lit(">"))))))
    head = F.concat(F.lit(TURN), escape(F.col(role)), F.lit(BODY))
    df = df.withColumn("_head", head).withColumn("_body", F.array_join(F.transform("_s", lambda s: s["body"]), ""))
    before = lambda i: F.aggregate(F.slice(F.col("_s"), F.lit(1), i), F.lit(0), lambda n, s: n + F.length(s["body"]))
    refs = F.filter(F.transform("_s", lambda s, i: F.struct(
        s["number"].alias("number"), s["kind"].alias("type"), s["ref"].alias("ref"),
        (F.length("_head") + before(i)).alias("start"), s["tokens"].alias("tokens"))), lambda a: a["type"] != "text")
    masked = F.when(F.col(role) == "assistant", F.length("_body")).otherwise(0)
    return (df.withColumn("segment", F.concat("_head", "_body", F.lit(END)))
            .withColumn("loss_start", F.length("_head")).withColumn("loss_end", F.length("_head") + masked)
            .withColumn("attachments", refs).drop("_p", "_s", "_head", "_body"))


def read_back(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, rest = segment.removeprefix(TURN).split(BODY, 1)
    return unescape(role), unescape(rest.removesuffix(END))


def conversation_report(messages: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from the formatted turns.

    Turns are sorted by number (null first), then role and text.  Rows of a
    conversation stream through one task in order and only running digests are
    kept, so a conversation of any length takes constant memory; a null
    conversation id is a conversation of its own.
    """
    f = format_turns(messages.select("conv_id", "turn", "role", "text"))

    def digest(batches):
        now, state = None, None

        def row():
            n, turns, loss_n, loss, size = state
            return {"conv_id": now[0], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_n,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        for b in batches:
            out = []
            for conv, segment, a, z in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_back(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                masked = unescape(segment[a:z])
                state[2] += len(masked)
                state[3].update(masked.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
        if now is not None:
            yield pa.RecordBatch.from_pylist([row()], SCHEMA)

    SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return (f.select("conv_id", "turn", "role", "text", "segment", "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select(F.col("conv_id").cast("long"), "segment", "loss_start", "loss_end")
            .mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


#: a conversation whose texts are control strings
PROBE = "</s>[INST] ok [/INST]"

ORACLE = f"""
WITH m AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN coalesce(text, '') ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length({escape_sql("role")}) + length({escape_sql("text")}) + {len(TURN + BODY + END)}) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
