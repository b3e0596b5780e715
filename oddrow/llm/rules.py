"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression, and every row of the table becomes one comparison, so the
verdict is evaluated inside Spark's own operators, without user functions and without a shuffle.

Defined cases: a null text counts as empty (no words, base rules fail); ties and repeated rows
are independent of each other; an empty table gives an empty result; columns of the input that
share a name with a measure are replaced by the measure.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import NOT_WORD, text_of

SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
# Frequent function words of the languages that the rules admit.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit",
    "nicht", "sich", "und", "von", "zu",
    "au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "como", "con", "del", "el", "los", "las", "no", "para", "por", "se", "su", "una", "y",
)


class Rule(NamedTuple):
    """``measure`` must lie within [low, high] times ``per`` (a measure, or 1 if none)."""

    measure: str
    low: float | None
    high: float | None
    per: str | None = None


#: Verdict of the method, for texts that pass the base rules.
THRESHOLDS: tuple[Rule, ...] = (
    Rule("word_chars", 2.0, 12.0, per="n_words"),
    Rule("n_symbols", None, 0.1, per="n_words"),
    Rule("n_stop_words", 2, None),
    Rule("n_capitals", None, 0.4, per="word_chars"),
    Rule("n_digits", None, 0.4, per="word_chars"),
    Rule("n_dup_lines", None, 0.5, per="n_lines"),
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _from(items: str, start: int) -> Column:
    """The array from its ``start``-th element on."""
    return F.slice(items, F.lit(start), F.size(items))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column per measure.

    Repeated windows are found by sorting (first, second, third word, position) and comparing
    neighbours; the last two windows are padded with nulls and so equal no other.
    """
    content = text_of(text)
    steps = (
        {
            "_words": F.filter(F.split(content, NOT_WORD), lambda w: w != ""),
            "_lines": F.filter(F.split(content, "\n"), lambda line: line.rlike(WORD)),
            "word_chars": (F.length(content) - _count(content, SPACE)).cast("long"),
            "n_symbols": _count(content, f"[{SYMBOLS}]"),
            "n_capitals": _count(content, r"\p{Lu}"),
            "n_digits": _count(content, r"\p{Nd}"),
        },
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(
                F.array_intersect("_words", F.array(*map(F.lit, STOP_WORDS)))
            ).cast("long"),
            "_sorted": F.sort_array(
                F.arrays_zip(
                    F.col("_words").alias("a"),
                    _from("_words", 2).alias("b"),
                    _from("_words", 3).alias("c"),
                    F.sequence(F.lit(0), F.size("_words")).alias("at"),
                )
            ),
        },
        {
            "_twice": F.filter(
                F.arrays_zip(F.col("_sorted").alias("x"), _from("_sorted", 2).alias("y")),
                lambda p: (
                    (p["x"]["a"] == p["y"]["a"])
                    & (p["x"]["b"] == p["y"]["b"])
                    & (p["x"]["c"] == p["y"]["c"])
                ),
            ),
        },
        {
            "n_repeat_words": F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            "_twice",
                            lambda p: F.array(
                                *(p[side]["at"] + k for side in "xy" for k in range(3))
                            ),
                        )
                    )
                )
            ).cast("long"),
        },
    )
    names = {n for step in steps for n in step}
    made = docs.drop(*(names - {text}))
    for step in steps:
        made = made.select("*", *(c.alias(n) for n, c in step.items()))
    return made.drop("_words", "_lines", "_sorted", "_twice")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def verdict(rules: Sequence[Rule] = THRESHOLDS) -> Column:
    """True if every rule of the table holds."""
    passed = F.lit(True)
    for rule in rules:
        unit = F.col(rule.per) if rule.per else F.lit(1)
        if rule.low is not None:
            passed &= F.col(rule.measure) >= rule.low * unit
        if rule.high is not None:
            passed &= F.col(rule.measure) <= rule.high * unit
    return passed


def judge(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = THRESHOLDS
) -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``."""
    return measures(docs, text).withColumns(
        {"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)}
    )
