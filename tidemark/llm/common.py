"""What the operators of this subpackage share: texts, rows with their columns, task functions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Task functions travel with the query, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The white space that separates words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, cut at white space (``SPACES``); none for an empty text."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.filter(F.split(trimmed, r"[ \t\n\x0B\f\r]+"), lambda word: word != "")


def as_row(docs: DataFrame, **columns: Column) -> DataFrame:
    """All of a row's columns as the struct ``row``, and the named columns beside it.

    Operators that return their input's columns work on this form, so that no helper
    column can clash with a column of the input.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[
        column.alias(name) for name, column in columns.items()
    ])


def groups(texts: list, size: int = 2 << 20) -> Iterator[tuple[int, list]]:
    """Consecutive texts of about ``size`` bytes together, with the place of the first."""
    start, held, total = 0, [], 0
    for at, text in enumerate(texts):
        held.append(text)
        total += len(text)
        if total >= size:
            yield start, held
            start, held, total = at + 1, [], 0
    if held:
        yield start, held
