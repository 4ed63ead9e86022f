"""Text summaries of entities and prompt assembly.

Summaries are built with ``concat_ws`` over ``when`` expressions (a skipped
null is a null argument), so the whole text step stays in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.operators.common import attach_row

# The instruction, few-shot framing and rating scale of the
# reference prompt; outcome 0 (survived) is written as rating 10, outcome 1 as 1.
PROMPT_HEAD = (
    "\nYou are a clinical prediction model. Based on the patient's ICU data, output ONLY a score "
    "from 1 to 10 indicating the likelihood the patient will be discharged alive "
    "(1 = very unlikely, 10 = very likely).\n\n"
    "DO NOT explain your reasoning. DO NOT add any text or interpretation. "
    "ONLY reply with a number from 1 to 10.\n\n"
    "Here are example patients and outcomes:\n[\n"
)
PROMPT_MIDDLE = "\n]\n\nNow predict for this patient, ONLY REPLY WITH A NUMBER FROM 1 TO 10 like this 'NUMBER':\n"
PROMPT_TAIL = "\n"
OUTCOME_SEP = " ===> Outcome :"
RATING_SURVIVED = 10
RATING_DIED = 1
FEWSHOT_FIRST = 5
FEWSHOT_WINDOW = 32


def feature_phrase(name: str, descriptions: dict) -> str:
    """F8: the words for a feature column.

    A name of exactly two words joined by one underscore is a variable and a
    statistic; it reads as statistic, variable and the variable's description,
    if there is one, with VAR written out.  Any other name stands for itself.
    """
    named = re.fullmatch(r"(?P<variable>[^_]*)_(?P<statistic>[^_]*)", name)
    if named is None:
        return name
    words = [named["statistic"], named["variable"].replace("VAR", "variance"), descriptions.get(named["variable"])]
    return " ".join(w for w in words if w is not None)


def round_half_even(c, digits: int = 2, guard_digits: int = 9):
    """Half-even rounding in binary floating point: ``rint(x * 10^d) / 10^d``
    (keeps the sign of a negative zero, like Python's ``round``).  The value
    is first rounded to ``guard_digits`` so that summation-order noise in the
    last bits of a mean cannot flip a tie."""
    scale = float(10 ** digits)
    x = F.round(c.cast("double"), guard_digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def summary_column(features, descriptions: dict, digits: int = 2):
    """``"phrase value. phrase value."``, nulls skipped, values rounded
    half-even to ``digits``; no value at all gives ``"."``."""
    parts = [F.when(F.col(f"`{f}`").isNotNull(),
                    F.concat(F.lit(feature_phrase(f, descriptions) + " "),
                             round_half_even(F.col(f"`{f}`"), digits).cast("string")))
             for f in features]
    return F.concat(F.concat_ws(". ", *parts), F.lit("."))


def summaries(df: DataFrame, features, descriptions: dict, id_col: str = "RecordID") -> DataFrame:
    """F9 over a feature table -> ``(id, summary)``.  Unknown feature names are ignored."""
    present = [f for f in features if f in df.columns]
    return df.select(F.col(id_col), summary_column(present, descriptions).alias("summary"))


def outcome_line(summary_col: str = "summary", label_col: str = "label"):
    """``summary ===> Outcome :10`` (label 0) or ``:1`` (label 1)."""
    rating = F.when(F.col(label_col) == 0, F.lit(RATING_SURVIVED)).otherwise(F.lit(RATING_DIED))
    return F.concat(F.col(summary_col), F.lit(OUTCOME_SEP), rating.cast("string"))


def fewshot_examples(summ: DataFrame, outcomes: DataFrame, id_col: str = "RecordID",
                     first: int = FEWSHOT_FIRST, window: int = FEWSHOT_WINDOW) -> DataFrame:
    """W4 + F10: the first ``first`` entities in id order, plus the positive
    ones among the first ``window``, as outcome lines with their position.

    ``orderBy(id).limit(window)`` is a top-k (each task keeps ``window``
    rows), so only ``window`` rows ever meet in one place.
    """
    head = summ.orderBy(id_col).limit(window)
    ranked = (head.join(outcomes, id_col, "left")
              .withColumn("_i", F.row_number().over(Window.orderBy(id_col)) - 1))
    return (ranked.where((F.col("_i") < first) | (F.col("label") == 1))
            .select(F.col(id_col), F.col("_i").alias("position"), outcome_line().alias("line")))


def prompts(summ: DataFrame, examples: DataFrame, id_col: str = "RecordID") -> DataFrame:
    """the fixed instruction, the example lines (in position order) and
    the entity's summary.  The example block is one bounded string attached
    to every row."""
    block = examples.agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "line"))), lambda s: s["line"]),
        "\n").alias("_examples"))
    return attach_row(summ, block).select(
        F.col(id_col),
        F.concat(F.lit(PROMPT_HEAD), F.col("_examples"), F.lit(PROMPT_MIDDLE), F.col("summary"),
                 F.lit(PROMPT_TAIL)).alias("prompt"))


def clean_response(chunks_col: str) -> "F.Column":
    """concatenate reply chunks and strip surrounding whitespace
    (newlines included, like Python's ``strip``)."""
    return F.regexp_replace(F.array_join(F.col(chunks_col), ""), r"^\s+|\s+$", "")


def response_score(text_col: str):
    """first integer in the reply, null when there is none."""
    return F.expr(f"try_cast(nullif(regexp_extract(`{text_col}`, '(\\\\d+)', 1), '') AS INT)")


def rating_to_probability(rating_col: str = "Prediction"):
    """a 1-10 'discharged alive' rating -> death probability ``1 - r/10``."""
    return F.lit(1.0) - F.col(rating_col).cast("double") / F.lit(10.0)


def rating_to_class(rating_col: str = "Prediction"):
    """probability rounded half-even to 0 or 1."""
    return F.bround(rating_to_probability(rating_col), 0).cast("int")


def score_predictions(preds: DataFrame, outcomes: DataFrame, id_col: str = "RecordID",
                      rating_col: str = "Prediction") -> DataFrame:
    """Join predictions to outcomes by key (never by position) and
    return ``(id, label, probability, pred)`` for the metric operators."""
    return (preds.join(outcomes, id_col)
            .select(F.col(id_col), F.col("label"), rating_to_probability(rating_col).alias("probability"),
                    rating_to_class(rating_col).alias("pred")))


def batch_inference(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Apply a caller-supplied model to Arrow batches (``mapInPandas``).

    ``fn`` maps a pandas DataFrame batch to a pandas DataFrame with
    ``schema``; it runs on the executors, batch by batch.  No client for a
    remote service is built in.
    """
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)
