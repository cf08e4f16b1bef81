"""Quality rules: one table of thresholds, compiled into one projection.

Every measure is a column expression over the whole text and every rule compares one
measure, or the ratio of two, with its limits. All rules together are one boolean
column; nothing is shuffled and no user function runs.

Defined results: a missing text counts as empty; an empty text has no words and fails;
repeated rows are judged alike; an empty table gives an empty table; other columns of the
input, whatever their names, do not take part.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, as_row, bind, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "be", "as", "are",
    "this", "by", "from", "or", "have", "an", "not", "but",
    "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "mit", "von", "dem", "für", "auf",
    "le", "la", "les", "des", "et", "un", "une", "du", "que", "qui", "dans", "pour", "est", "par", "au",
    "el", "los", "las", "y", "de", "en", "por", "con", "una", "para", "del", "se", "no", "lo",
)


class Rule(NamedTuple):
    """``low <= measure / per <= high`` for texts of at least ``words`` words."""

    measure: str
    per: str | None
    low: float | None
    high: float | None
    words: int = 0


# Limits that ordinary prose in any of the languages keeps by a wide margin.
RULES = (
    Rule("n_words", None, 10, None),
    Rule("n_repeat_words", "n_words", None, 0.2),
    Rule("word_chars", "n_words", 1.5, 25.0),
    Rule("n_symbols", "n_words", None, 0.5),
    Rule("n_dup_lines", "n_lines", None, 0.5),
    Rule("n_stop_words", "n_words", 0.005, None, words=100),
)
BASE = RULES[:2]


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five that occurs twice or more in the text.

    Windows are compared by a 64-bit hash; only texts with equal windows are sorted.
    """
    grams = F.when(
        F.size(words) >= WINDOW,
        bind(
            F.transform(words, lambda w: F.xxhash64(w)),
            lambda h: F.transform(
                F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
                lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(WINDOW)]),
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def places(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def doubled(s: Column) -> Column:
            def marked(x: Column, at: Column) -> Column:
                same = (F.get(s, at - 1)["g"] == x["g"]) | (F.get(s, at + 1)["g"] == x["g"])
                return F.when(same, x["i"])

            return F.sort_array(F.filter(F.transform(s, marked), lambda i: i.isNotNull()))

        return bind(ordered, doubled)

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct(
                (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda a: a["n"],
        )

    return bind(
        grams,
        lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(places(g))).otherwise(
            F.lit(0).cast("bigint")
        ),
    )


def measures(df: DataFrame, text: Column) -> DataFrame:
    """Adds every measure of ``text`` that the rules use, as long columns."""
    df = df.withColumn("_text", text).withColumn("_words", words_of(F.col("_text")))
    t, words = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counted = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(t, SPACES, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
    }
    return df.select(
        *[c for c in df.columns if c not in ("_text", "_words")],
        *[column.cast("bigint").alias(name) for name, column in counted.items()],
    )


def passes(rules: tuple[Rule, ...]) -> Column:
    """The whole table of rules as one boolean column; products, so that no limit is divided."""
    checks = []
    for rule in rules:
        per = F.col(rule.per) if rule.per else F.lit(1)
        value = F.col(rule.measure)
        holds = F.lit(True)
        if rule.low is not None:
            holds = holds & (value >= per * rule.low)
        if rule.high is not None:
            holds = holds & (value <= per * rule.high)
        checks.append((F.col("n_words") < rule.words) | holds if rule.words else holds)
    return reduce(lambda a, b: a & b, checks)


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (the input's columns), the measures, ``base_failed`` and ``kept``."""
    measured = measures(as_row(docs, t=text_of(text)), F.col("t")).drop("t")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & passes(rules))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    return quality(docs).filter("kept").select("row.*")
