"""The complete jobs, each from a source DataFrame to its result.

``lines`` of a bounded job are ``(seq, value)``, from memory or files (whose rows are numbered in the
order of arrival where a job needs it); jobs that also run on a stream say so.
The ordered jobs on a stream give the stream and the function that works on its batches,
for ``run_to_end(*job, checkpoint)``; their sources number the records in ``seq``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.records import clean_orders, numbered_words, timed_words, words
from tidemark.operators.alarm import refund_alarm
from tidemark.operators.changelog import sum_changelog, union_sources
from tidemark.operators.emit import FIRING_WORD, HORIZON_MS, conditional_emit
from tidemark.operators.lateness import classify_late, firing_rows, firings, kept_sums, side_output
from tidemark.operators.running import final_count, running_sum
from tidemark.operators.windows import (
    relabel_double,
    tumbling_count,
    tumbling_sum,
    window_apply,
    windowed,
    with_ingest_time,
    with_watermark,
)
from tidemark.sources.arrival import in_order
from tidemark.sources.kafka import string_values
from tidemark.sources.tables import declare_sink, register_table
from tidemark.streaming.carried import (
    Batch,
    alarm_table,
    changelog_table,
    emit_table,
    late_table,
    running_sum_table,
)
from tidemark.streaming.sinks import write_csv

# Schemas of the SQL jobs.
SALES_SCHEMA = "user_id int, product string, order_amount double"
AMOUNT_SCHEMA = "order_id string, amount double"


def running_word_count(lines: DataFrame, by: str = "comma") -> DataFrame:
    """Per word in reading order, the count so far."""
    tokens = numbered_words(in_order(lines), by=by)
    return running_sum(tokens, "word", ["seq", "pos"], "cnt", "total")


def stream_running_word_count(lines: DataFrame, path: str, by: str = "comma") -> tuple[DataFrame, Batch]:
    """``running_word_count`` on a stream of lines: one row per word read."""
    return numbered_words(lines, by=by), running_sum_table(path, "word", order=("seq", "pos"))


def word_totals(lines: DataFrame, by: str = "comma") -> DataFrame:
    """Counts per word; on a stream, per micro-batch in update or complete mode."""
    return final_count(words(lines, by=by), "word")


def kafka_word_totals(records: DataFrame) -> DataFrame:
    """``word_totals`` over the string values of Kafka records; also on a stream."""
    return word_totals(string_values(records).select("value"))


def student_scores(students: DataFrame) -> DataFrame:
    """Per student in ``seq`` order, the score sum so far. For streams see below."""
    return running_sum(in_order(students), "name", "seq", "score", "total")


def stream_student_scores(students: DataFrame, path: str) -> tuple[DataFrame, Batch]:
    """``student_scores`` on a stream, one row per record."""
    return students, running_sum_table(path, "name", "score")


def words_per_window(lines: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Counts per word and window of ``ts``; also on a watermarked stream."""
    return tumbling_count(words(lines), "ts", width, ["word"])


def words_per_sliding_window(
    lines: DataFrame, width: str = "5 seconds", slide: str = "1 second"
) -> DataFrame:
    """Counts per word and sliding window of ``ts``; also on a watermarked stream."""
    return windowed(words(lines), "ts", width, ["word"], slide, cnt=F.count("*"))


def stream_words_per_window(lines: DataFrame, width: str = "5 seconds") -> DataFrame:
    """``words_per_window`` by the time lines are read."""
    return words_per_window(with_ingest_time(lines), width)


def triggered_words(
    lines: DataFrame, word: str = FIRING_WORD, horizon_ms: int = HORIZON_MS
) -> DataFrame:
    """``(seq, ts_ms, word, cnt)`` for every ``word`` but the first."""
    tokens = words(in_order(lines)).where(F.col("word") == word).drop("cnt")
    return conditional_emit(tokens, "word", F.lit(True), horizon_ms=horizon_ms)


def stream_triggered_words(
    lines: DataFrame, path: str, horizon_ms: int = HORIZON_MS
) -> tuple[DataFrame, Batch]:
    """``triggered_words`` on a stream of ``(seq, ts_ms, value)``."""
    tokens = words(lines).drop("cnt")
    return tokens, emit_table(path, "word", order=("ts_ms", "seq"), horizon_ms=horizon_ms)


def words_per_window_applied(lines: DataFrame, width_ms: int = 5_000) -> DataFrame:
    """``words_per_window`` through a user function over each window's elements."""

    def add(part: pd.DataFrame) -> dict:
        return {"cnt": int(part["cnt"].sum())}

    tokens = words(lines).select("word", "ts", "cnt")
    return window_apply(tokens, "ts", width_ms, ["word"], add, add, "cnt bigint")


def doubled_words(lines: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Every (word, window) count doubled under one label; also on a watermarked stream."""
    return relabel_double(words_per_window(lines, width)).select("word", "cnt")


def timed_word_sums(lines: DataFrame, width_ms: int = 5_000, bound_ms: int = 2_000) -> DataFrame:
    """Sums per word and event-time window; records behind the watermark are dropped."""
    return kept_sums(classify_late(timed_words(in_order(lines)), "ts_ms", "seq", width_ms, bound_ms), ["word"])


def stream_timed_word_sums(
    lines: DataFrame, width: str = "5 seconds", bound: str = "2 seconds"
) -> DataFrame:
    """``timed_word_sums`` on a stream, where the watermark moves once per micro-batch."""
    timed = with_watermark(timed_words(lines), "ts", bound)
    return tumbling_sum(timed, "ts", width, ["word"])


def late_word_windows(
    lines: DataFrame, width_ms: int = 5_000, bound_ms: int = 2_000, lateness_ms: int = 2_000
) -> tuple[DataFrame, DataFrame]:
    """First element per firing, and the side output of records that came too late."""
    classified = classify_late(
        timed_words(in_order(lines)), "ts_ms", "seq", width_ms, bound_ms, lateness_ms
    )
    main = firing_rows(firings(classified, ["word"])).select("word", "cnt")
    return main, side_output(classified).select("word", "cnt")


def stream_late_word_windows(lines: DataFrame, path: str, **times: int) -> tuple[DataFrame, Batch]:
    """``late_word_windows`` on a stream of lines; rows are tagged by ``kind``."""
    return timed_words(lines).select("seq", "ts_ms", "word", "cnt"), late_table(path, **times)


def order_alarms(lines: DataFrame) -> DataFrame:
    """Alarms over order lines ``(seq, ts_ms, value)``."""
    return refund_alarm(clean_orders(in_order(lines)))


def stream_order_alarms(lines: DataFrame, path: str, ts_ms: str | None = None) -> tuple[DataFrame, Batch]:
    """``order_alarms`` on a stream of lines, by processing time unless ``ts_ms`` is given."""
    return clean_orders(lines), alarm_table(path, ts_ms=ts_ms)


def sales_totals(spark: SparkSession, source: str, sink: str) -> DataFrame:
    """CSV to CSV in SQL: total amount per user, appended to ``sink``."""
    register_table(spark, "csv_source", SALES_SCHEMA, "csv", path=source)
    totals = spark.sql(
        "SELECT user_id, SUM(order_amount) AS total_amount FROM csv_source GROUP BY user_id"
    )
    write_csv(totals, sink)
    return totals


def insert_sales_totals(spark: SparkSession, source: str, sink: str) -> None:
    """The same in SQL alone: ``INSERT INTO`` a declared CSV table."""
    register_table(spark, "csv_source", SALES_SCHEMA, "csv", path=source)
    declare_sink(spark, "csv_sink", "user_id int, total_amount double", sink)
    spark.sql("INSERT INTO csv_sink SELECT user_id, SUM(order_amount) FROM csv_source GROUP BY user_id")


def unified_amounts(*sources: DataFrame) -> DataFrame:
    """The amounts of bounded or streaming order sources, with ``seq`` where all have it.

    On a stream read the bounded side as a file stream too: a stream and a bounded
    table cannot be unioned. ``changelog_table`` turns the result into a changelog.
    """
    columns = ["seq", "amount"] if all("seq" in s.columns for s in sources) else ["amount"]
    return union_sources(*[s.select(columns) for s in sources])


def stream_unified_changelog(amounts: DataFrame, path: str) -> tuple[DataFrame, Batch]:
    """The changelog of the total over a stream of amounts, such as a SQL union of registered tables."""
    return amounts, changelog_table(path)


def unified_changelog(numbered: DataFrame) -> DataFrame:
    """Changelog of the total over bounded ``(seq, amount)`` rows, such as ``unified_amounts``."""
    return sum_changelog(in_order(numbered), scale=None)
