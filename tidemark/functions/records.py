"""From raw lines to typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_numbers
from tidemark.functions.text import split_commas, split_spaces

# Fixed values of the order record.
PAID = 1
REFUNDED = 2
ORDER_SCHEMA = "id int, title string, amount int, state int, user_id string"


def words(df: DataFrame, line: str = "value", by: str = "space") -> DataFrame:
    """One row ``(word, cnt = 1)`` per word of each line, other columns kept."""
    split = {"comma": split_commas, "space": split_spaces}[by]
    others = [c for c in df.columns if c != line]
    return df.select(*others, F.explode(split(F.col(line))).alias("word"), F.lit(1).alias("cnt"))


def numbered_words(df: DataFrame, line: str = "value", seq: str = "seq", by: str = "comma") -> DataFrame:
    """Like ``words``, with the word's place in its line as second order column ``pos``."""
    split = {"comma": split_commas, "space": split_spaces}[by]
    return df.select(
        seq, F.posexplode(split(F.col(line))).alias("pos", "word"), F.lit(1).alias("cnt")
    )


def timed_words(df: DataFrame, line: str = "value", on_error: str = "fail") -> DataFrame:
    """``"<epoch ms>,<word>"`` lines as ``(ts_ms, ts, word, cnt = 1)``."""
    fields = split_commas(F.col(line))
    split = df.withColumn("_fields", fields)
    word = F.get(F.col("_fields"), F.lit(1))
    if on_error == "drop":
        split = split.where(F.size("_fields") >= 2)
    else:
        missing = F.raise_error(F.concat(F.lit("line without a word: "), F.col(line)))
        word = F.coalesce(word, missing.cast("string"))
    parsed = parse_numbers(
        split, {"ts_ms": (F.get(F.col("_fields"), F.lit(0)), "bigint")}, on_error
    )
    others = [c for c in df.columns if c != line]
    return parsed.select(
        *others,
        "ts_ms",
        F.timestamp_millis("ts_ms").alias("ts"),
        word.alias("word"),
        F.lit(1).alias("cnt"),
    )


def clean_orders(df: DataFrame, line: str = "value", on_error: str = "fail") -> DataFrame:
    """Order lines ``id,title,amount,state,user_id`` as typed rows.

    Blank lines and lines of fewer than five fields are left out, fields after
    the fifth are ignored, malformed numbers follow ``on_error``.
    """
    others = [c for c in df.columns if c != line]
    # Blank lines and lines of separators only have one field here: they go as well.
    fields = F.split(F.rtrim(F.col(line), F.lit(",")), ",")
    complete = df.where(F.size(fields) >= 5).select(*others, fields.alias("_fields"))
    parsed = parse_numbers(
        complete,
        {
            "id": (F.col("_fields")[0], "int"),
            "amount": (F.col("_fields")[2], "int"),
            "state": (F.col("_fields")[3], "int"),
        },
        on_error,
    )
    return parsed.select(
        *others,
        "id",
        F.col("_fields")[1].alias("title"),
        "amount",
        "state",
        F.col("_fields")[4].alias("user_id"),
    )
