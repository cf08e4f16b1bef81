"""Splitting lines into words with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a single-whitespace split treats as separators.
WHITESPACE = " \t\n\x0b\f\r"


def _split(line: Column, separators: str, pattern: str) -> Column:
    # Trailing empty words do not count, so trailing separators go first; a line
    # of separators only has no words, while an empty line has one empty word.
    trimmed = F.rtrim(line, F.lit(separators))
    only_separators = (trimmed == "") & (line != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, pattern)
    )


def split_commas(line: Column) -> Column:
    """Words between commas; leading and inner empties stay, trailing ones go."""
    return _split(line, ",", ",")


def split_spaces(line: Column) -> Column:
    """Words between *single* whitespace characters, same rule for empties."""
    return _split(line, WHITESPACE, r"\s")


def lines_of(text: Column) -> Column:
    """A whole text as its newline-delimited lines."""
    return F.split(text, "\n")
