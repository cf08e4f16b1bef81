"""Line sources: in-memory lines, text files, and a stream of lines over files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.arrival import file_arrival

LINE_SCHEMA = "value string"


def from_lines(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """A small bounded collection as ``(seq, value)``, numbered in the given order."""
    return spark.createDataFrame(list(enumerate(lines)), "seq bigint, value string")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files as ``(value, seq)``; ``in_order`` turns ``seq`` into numbers."""
    return spark.read.schema(LINE_SCHEMA).text(path).select("value", file_arrival().alias("seq"))


def stream_lines(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """New text files of a folder as an unbounded stream of ``(value, seq)``.

    ``seq`` is the order of arrival: file by file as they were written, line by line.
    """
    lines = spark.readStream.schema(LINE_SCHEMA).option("maxFilesPerTrigger", max_files).text(path)
    return lines.select("value", file_arrival().alias("seq"))
