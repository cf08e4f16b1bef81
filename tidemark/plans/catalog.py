"""The registered queries: every operator over the whole test tables.

Window bounds are given in epoch milliseconds and money in whole cents, so results
compare exactly with the SQL in ``oracles``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import to_cents, to_millis
from tidemark.functions.records import clean_orders, timed_words, words
from tidemark.functions.text import lines_of
from tidemark.operators.alarm import refund_alarm
from tidemark.operators.changelog import sum_changelog, total, union_sources
from tidemark.operators.emit import conditional_emit
from tidemark.operators.lateness import (
    classify_late,
    firing_rows,
    firings,
    kept_sums,
    side_output,
)
from tidemark.operators.rolling import rolling
from tidemark.operators.running import final_count, final_sum, running_count, running_sum
from tidemark.operators.windows import (
    relabel_double,
    sliding_sum,
    tumbling_count,
    tumbling_sum,
    window_apply,
    window_first,
    with_watermark,
)
from tidemark.plans import jobs
from tidemark.plans.tables import spread, table
from tidemark.session import shared_dir
from tidemark.sources.arrival import in_order
from tidemark.sources.kafka import json_rows
from tidemark.sources.lines import read_lines, stream_lines
from tidemark.sources.tables import declare_sink, read_csv, register_table
from tidemark.streaming import sinks
from tidemark.streaming.carried import (
    Batch,
    alarm_table,
    changelog_table,
    emit_table,
    group_changelog_table,
    late_table,
    open_windows,
    read_kind,
    read_latest,
    read_rows,
    running_count_table,
    running_sum_table,
    update_table,
)
from tidemark.streaming.timers import ALARM, refund_waits
from tidemark.streaming.windowed import apply_table, open_records, open_sliding, sliding_table

Query = Callable[[SparkSession, str], DataFrame]

HOUR_MS = 3_600_000
WIDTH, WIDTH_MS = "6 hours", 6 * HOUR_MS
DAY_MS = 24 * HOUR_MS
# Lateness queries: windows of 6 h, a watermark 2 h behind, 2 h allowed lateness.
BOUND_MS = LATENESS_MS = 2 * HOUR_MS
# Slices of the order of arrival, each a micro-batch of a registered stream, in so many files at least.
SLICES, FILES = 8, 2
# Rows of a file, until there is a file for every core.
ROWS_PER_FILE = 8_000
LATE_SLICES = 4


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def _millis_windows(df: DataFrame) -> DataFrame:
    """Window bounds as milliseconds, first columns as they are."""
    bounds = {
        "window_start": to_millis(F.col("window_start")).alias("start_ms"),
        "window_end": to_millis(F.col("window_end")).alias("end_ms"),
    }
    return df.select(*[bounds.get(c, F.col(c)) for c in df.columns])


# --- words -----------------------------------------------------------------------


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spread(table(spark, sf_dir, "documents").select("text"))
    lines = texts.select(F.explode(lines_of(F.col("text"))).alias("value"))
    return final_count(words(lines), "word")


def csv_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # Every fifth line ends in separators, which make no words.
    tail = F.when(F.col("event_id") % 5 == 0, ",,").otherwise("")
    line = F.concat("event_type", F.lit(","), F.col("user_id").cast("string"), F.lit(",,x"), tail)
    return final_count(words(events.select(line.alias("value")), by="comma"), "word")


# --- rolling aggregation ---------------------------------------------------------


def query_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return running_count(events, "event_type", "event_id")


def _cents_events(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", to_cents(F.col("value")).alias("cents"))


def query_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _cents_events(table(spark, sf_dir, "events"))
    return running_sum(events, "user_id", "event_id", "cents").drop("cents")


# --- windows ---------------------------------------------------------------------


def query_tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _millis_windows(tumbling_count(events, "ts", WIDTH, ["event_type"]))


def query_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("cents", to_cents(F.col("value")))
    return _millis_windows(tumbling_sum(events, "ts", WIDTH, ["user_id"], "cents", "total"))


def query_window_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_type", "ts", to_cents(F.col("value")).alias("cents")
    )

    def fold(part: pd.DataFrame) -> dict:
        return {"n": len(part), "total": int(part["cents"].sum()), "most": int(part["cents"].max())}

    def merge(part: pd.DataFrame) -> dict:
        return {
            "n": int(part["n"].sum()),
            "total": int(part["total"].sum()),
            "most": int(part["most"].max()),
        }

    return window_apply(
        events, "ts", WIDTH_MS, ["event_type"], fold, merge, "n bigint, total bigint, most bigint"
    )


def query_window_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("cents", to_cents(F.col("value")))
    first = window_first(events, "ts", WIDTH, ["event_type"], "event_id", ["event_id", "cents"])
    return _millis_windows(first)


def window_relabel_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "word")
    counts = tumbling_count(events, "ts", WIDTH, ["word"])
    return _millis_windows(relabel_double(counts)).select("word", "start_ms", "cnt")


def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts_ms", to_millis(F.col("ts")))
    return sliding_sum(events, "ts_ms", WIDTH_MS, HOUR_MS, ["event_type"])


# --- late records ----------------------------------------------------------------


def _jittered(df: DataFrame) -> DataFrame:
    """Events out of order: each lies up to 8 h before its place in the arrival order."""
    jitter = (F.col("event_id") * 7919) % 97 * 300_000
    return df.select(
        F.col("event_id").alias("seq"),
        (to_millis(F.col("ts")) - jitter).alias("ts_ms"),
        F.col("event_type").alias("word"),
        F.lit(1).cast("bigint").alias("cnt"),
    )


def _late_events(spark: SparkSession, sf_dir: str, lateness_ms: int = LATENESS_MS) -> DataFrame:
    events = _jittered(table(spark, sf_dir, "events"))
    return classify_late(events, "ts_ms", "seq", WIDTH_MS, BOUND_MS, lateness_ms)


def late_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_events(spark, sf_dir).select("seq", "word", "ts_ms", "end_ms", "late_class")


def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_output(_late_events(spark, sf_dir)).select("seq", "word", "cnt")


def late_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return firings(_late_events(spark, sf_dir), ["word"], payload=["seq"]).withColumnRenamed(
        "seq", "first_seq"
    )


def late_main_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = firings(_late_events(spark, sf_dir), ["word"], payload=["cnt"])
    return firing_rows(fired).select("word", "end_ms", "cnt")


def late_drop_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_sums(_late_events(spark, sf_dir, lateness_ms=0), ["word"])


# --- conditional emission and alarm ----------------------------------------------


def _timed_events(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(F.col("event_id").alias("seq"), to_millis(F.col("ts")).alias("ts_ms"), *columns)


def query_conditional_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _timed_events(table(spark, sf_dir, "events"), "event_type")
    # The predicate is on the key, so other keys' records need not be counted.
    firing = events.where(F.col("event_type") == "error")
    return conditional_emit(firing, "event_type", F.lit(True), horizon_ms=WIDTH_MS)


def conditional_emit_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _timed_events(table(spark, sf_dir, "events"), "user_id", "event_type")
    fires = F.col("event_type") == "error"
    return conditional_emit(events, "user_id", fires, horizon_ms=DAY_MS).drop("event_type")


def rolling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest and the smallest amount of each user's last day, at every event."""
    events = _timed_events(table(spark, sf_dir, "events"), "user_id", to_cents(F.col("value")).alias("cents"))
    most = rolling(events, ["user_id"], "max", F.col("cents"), DAY_MS, "most")
    return rolling(most, ["user_id"], "min", F.col("cents"), DAY_MS, "least").drop("cents")


def _refund_events(df: DataFrame) -> DataFrame:
    state = F.when(F.col("event_type") == "error", 2).otherwise(1)
    return _timed_events(df, "user_id", state.alias("state"))


def query_refund_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _refund_events(table(spark, sf_dir, "events"))
    return refund_alarm(events, within_ms=DAY_MS).select("seq", "user_id", "ts_ms")


# --- orders, tables and SQL ------------------------------------------------------


def _order_lines(df: DataFrame) -> DataFrame:
    """Orders as lines; some blank, some a field short, some with a field too many."""
    number = F.col("o_orderkey")
    amount = F.floor("o_totalprice").cast("string")
    state = (number % 2 + 1).cast("string")
    user = F.concat(F.lit("user"), F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", number.cast("string"), "o_orderpriority", amount, state)
    return df.select(
        F.when(number % 13 == 0, " ")
        .when(number % 11 == 0, F.concat(line, F.lit(",")))
        .when(number % 7 == 0, F.concat_ws(",", line, user, F.lit("extra")))
        .otherwise(F.concat_ws(",", line, user))
        .alias("value")
    )


def query_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(_order_lines(table(spark, sf_dir, "orders")))


def _order_amounts(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").alias("seq"), "o_custkey", to_cents(F.col("o_totalprice")).alias("amount")
    )


def sql_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_amounts(table(spark, sf_dir, "orders"))
    return spark.sql(
        "SELECT o_custkey, SUM(amount) AS total FROM {orders} GROUP BY o_custkey", orders=orders
    )


def csv_sink_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals through a CSV table: written, then read back with the declared schema."""
    folder = _scratch(spark, "csv_sink_totals")
    sinks.write_csv(sql_group_sum(spark, sf_dir), folder)
    return read_csv(spark, folder, "o_custkey bigint, total bigint")


def _order_sides(df: DataFrame) -> list[DataFrame]:
    amounts = _order_amounts(df).select("seq", "amount")
    return [amounts.where(F.col("seq") % 2 == parity) for parity in (0, 1)]


def union_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total(union_sources(*_order_sides(table(spark, sf_dir, "orders"))))


def query_sum_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _order_amounts(table(spark, sf_dir, "orders"))
    # Every seventh amount is missing, every ninth nothing: neither changes the total.
    changed = F.when(F.col("seq") % 7 == 0, None).when(F.col("seq") % 9 == 0, 0)
    return sum_changelog(amounts.select("seq", changed.otherwise(F.col("amount")).alias("amount")))


def query_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return json_rows(events, "k bigint", "props").groupBy("k").agg(F.count("*").alias("cnt"))


# --- streams ---------------------------------------------------------------------


def _arriving(
    spark: SparkSession, name: str, df: DataFrame, seq: str, slices: int = SLICES
) -> tuple[DataFrame, str]:
    """``df`` as a stream of several micro-batches along ``seq``, and a folder for its results.

    Every row is in one slice, whatever its number.
    """
    folder = _scratch(spark, name)
    low, high, rows = df.agg(F.min(seq), F.max(seq), F.count("*")).first()
    # A task reads a file: large micro-batches are work for all cores.
    files = max(FILES, min(spark.sparkContext.defaultParallelism, rows // slices // ROWS_PER_FILE))
    df = df.persist()
    for i in range(slices):
        if low is None:
            inside = F.lit(i == 0)
        else:
            # Bounds of the numbers themselves: of the rows kept, only those near a slice are looked at.
            first, last = (low - (low - high - 1) * k // slices for k in (i, i + 1))
            inside = (F.col(seq) >= first) & (F.col(seq) < last)
        df.where(inside).repartition(files).write.mode("append").parquet(f"{folder}/in")
    df.unpersist()
    arriving = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    return arriving, f"{folder}/out"


def _carried_rows(
    spark: SparkSession, name: str, df: DataFrame, seq: str, sink: Callable[[str], Batch]
) -> DataFrame:
    """Run an ordered operator over ``df`` as a stream and read what it wrote."""
    arriving, out = _arriving(spark, name, df, seq)
    sinks.run_to_end(arriving, sink(out), f"{out}/checkpoint")
    return read_rows(spark, out)


def _updates(spark: SparkSession, name: str, df: DataFrame, schema: str, keys: list[str]) -> DataFrame:
    """Run an aggregation in update mode over all its input and read its last state."""
    folder = _scratch(spark, name)
    sinks.run_to_end(df, sinks.batch_table(f"{folder}/rows"), f"{folder}/checkpoint", "update")
    return sinks.read_updates(spark, f"{folder}/rows", schema, keys)


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, _ = _arriving(
        spark, "stream_word_count", table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"
    )
    lines = texts.select(F.explode(lines_of(F.col("text"))).alias("value"))
    return _updates(spark, "words", final_count(words(lines), "word"), "word string, cnt bigint", ["word"])


def stream_tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, those still open at the end of the input as well."""
    events, _ = _arriving(
        spark, "stream_tumbling_count", table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "event_id"
    )
    timed = with_watermark(events, "ts", "1 day")
    counts = _millis_windows(tumbling_count(timed, "ts", WIDTH, ["event_type"]))
    schema = "event_type string, start_ms bigint, end_ms bigint, cnt bigint"
    return _updates(spark, "windows", counts, schema, ["event_type", "start_ms", "end_ms"])


def query_stream_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _cents_events(table(spark, sf_dir, "events"))
    return _carried_rows(
        spark, "stream_running_sum", events, "event_id",
        lambda out: running_sum_table(out, "user_id", "cents", order=("event_id",)),
    ).drop("cents")


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return _carried_rows(
        spark, "stream_running_count", events, "event_id",
        lambda out: running_count_table(out, "event_type", order=("event_id",)),
    )


def query_stream_conditional_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _timed_events(table(spark, sf_dir, "events"), "event_type")
    return _carried_rows(
        spark, "stream_conditional_emit", events.where(F.col("event_type") == "error"), "seq",
        lambda out: emit_table(out, "event_type", F.lit(True), order=("ts_ms", "seq"), horizon_ms=WIDTH_MS),
    )


def stream_conditional_emit_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _timed_events(table(spark, sf_dir, "events"), "user_id", "event_type")
    fires = F.col("event_type") == "error"
    return _carried_rows(
        spark, "stream_conditional_emit_by_user", events, "seq",
        lambda out: emit_table(out, "user_id", fires, order=("ts_ms", "seq"), horizon_ms=DAY_MS),
    ).drop("event_type")


def query_stream_refund_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    refunds = _refund_events(table(spark, sf_dir, "events"))
    alarms = _carried_rows(
        spark, "stream_refund_alarm", refunds, "seq", lambda out: alarm_table(out, ts_ms="ts_ms", within_ms=DAY_MS)
    )
    return alarms.select("seq", "user_id", "ts_ms")


def _late_stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Late events of a stream whose numbers have gaps and begin below 0."""
    events = _jittered(table(spark, sf_dir, "events")).withColumn("seq", F.col("seq") * 3 - 1000)
    arriving, out = _arriving(spark, "stream_late", events, "seq", LATE_SLICES)
    sinks.run_to_end(arriving, late_table(out, WIDTH_MS, BOUND_MS, LATENESS_MS), f"{out}/checkpoint")
    return read_kind(spark, out, kind).select("word", "end_ms", "cnt")


def stream_late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_stream(spark, sf_dir, "late")


def stream_late_main_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_stream(spark, sf_dir, "main")


def stream_sum_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changelog of the total over the union of two streams."""
    amounts = _order_amounts(table(spark, sf_dir, "orders")).select("seq", "amount")
    arriving, out = _arriving(spark, "stream_sum_changelog", amounts, "seq")
    sides = [arriving.where(F.col("seq") % 2 == parity) for parity in (0, 1)]
    sinks.run_to_end(union_sources(*sides), changelog_table(out), f"{out}/checkpoint")
    return read_rows(spark, out)


# --- the documented forms: lines, declared tables, SQL -------------------------------------


def timed_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ``"<ms>,<word>"`` made from events, parsed again and counted per word and day."""
    events = table(spark, sf_dir, "events")
    lines = events.select(F.concat_ws(",", to_millis(F.col("ts")).cast("string"), "event_type").alias("value"))
    parsed = timed_words(lines)
    day = (F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(DAY_MS))).alias("day_ms")
    return parsed.groupBy("word", day).agg(F.sum("cnt").alias("cnt"))


def sql_insert_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``INSERT INTO`` a declared CSV table from a declared CSV table, in SQL alone."""
    folder = _scratch(spark, "sql_insert")
    sinks.write_csv(_order_amounts(table(spark, sf_dir, "orders")).select("o_custkey", "amount"), f"{folder}/in")
    name = f"t{uuid.uuid4().hex}"
    register_table(spark, f"{name}_in", "o_custkey bigint, amount bigint", "csv", path=f"{folder}/in")
    declare_sink(spark, f"{name}_out", "o_custkey bigint, total bigint", f"{folder}/out")
    spark.sql(f"INSERT INTO {name}_out SELECT o_custkey, SUM(amount) FROM {name}_in GROUP BY o_custkey")
    return read_csv(spark, f"{folder}/out", "o_custkey bigint, total bigint")


def stream_sql_union_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over two streaming CSV tables, a union, and the total of what has arrived."""
    folder = _scratch(spark, "sql_union")
    name = f"t{uuid.uuid4().hex}"
    for side, rows in zip("ab", _order_sides(table(spark, sf_dir, "orders")), strict=True):
        sinks.write_csv(rows.select("amount"), f"{folder}/{side}")
        register_table(spark, f"{name}{side}", "amount bigint", "csv", streaming=True, path=f"{folder}/{side}")
    totals = spark.sql(
        f"SELECT 1 AS k, SUM(amount) AS total FROM (SELECT amount FROM {name}a UNION ALL SELECT amount FROM {name}b)"
    )
    return _updates(spark, "sql_union_rows", totals, "k int, total bigint", ["k"]).select("total")


def text_line_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files, read as a stream of lines and counted by word."""
    folder = _scratch(spark, "text_lines")
    texts = table(spark, sf_dir, "documents").select(F.explode(lines_of(F.col("text"))).alias("value"))
    texts.write.text(f"{folder}/in")
    counts = final_count(words(stream_lines(spark, f"{folder}/in")), "word")
    return _updates(spark, "text_line_rows", counts, "word string, cnt bigint", ["word"])


def _in_files(df: DataFrame, seq: str) -> DataFrame:
    """``df`` cut along ``seq`` into as many files as there are cores, named in order."""
    files = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(files, seq).sortWithinPartitions(seq).drop(seq)


def text_running_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running word count of text files, numbered in the order of their names."""
    folder = _scratch(spark, "text_running")
    line = F.concat_ws(",", "event_type", F.col("user_id").cast("string"))
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("value"))
    _in_files(lines, "event_id").write.text(f"{folder}/in")
    return jobs.running_word_count(in_order(read_lines(spark, f"{folder}/in"), by="name")).drop("cnt")


def csv_unified_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two declared CSV tables, their union in SQL, and the changelog of its total."""
    folder = _scratch(spark, "csv_unified")
    name = f"t{uuid.uuid4().hex}"
    for side, rows in zip("ab", _order_sides(table(spark, sf_dir, "orders")), strict=True):
        _in_files(rows, "seq").write.csv(f"{folder}/{side}")
        register_table(spark, f"{name}{side}", "amount bigint", "csv", path=f"{folder}/{side}")
    union = spark.sql(f"SELECT seq, amount FROM {name}a UNION ALL SELECT seq, amount FROM {name}b")
    return jobs.unified_changelog(in_order(union, by="name"))


def _late_records(spark: SparkSession, sf_dir: str) -> str:
    """The late events as a stream whose watermark moves with every record; the folder of its results."""
    events = _jittered(table(spark, sf_dir, "events"))
    arriving, out = _arriving(spark, "stream_late_records", events, "seq", LATE_SLICES)
    sink = late_table(out, WIDTH_MS, BOUND_MS, LATENESS_MS, per_record=True)
    sinks.run_to_end(arriving, sink, f"{out}/checkpoint")
    return out


def stream_late_records_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_kind(spark, _late_records(spark, sf_dir), "late").select("word", "end_ms", "cnt")


def stream_late_records_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All firings, those of the windows still open at the end of the input as well."""
    out = _late_records(spark, sf_dir)
    main = read_kind(spark, out, "main").select("word", "end_ms", "cnt")
    return main.unionByName(open_windows(spark, out))


# The three largest amounts of a window, and their sum: no built-in aggregate gives it.
TOP_SCHEMA = "n bigint, largest array<bigint>"


def _top_fold(part: pd.DataFrame) -> dict:
    return {"n": len(part), "largest": sorted(part["cents"].tolist(), reverse=True)[:3]}


def _top_merge(part: pd.DataFrame) -> dict:
    return {"n": int(part["n"].sum()), "largest": sorted((c for top in part["largest"] for c in top), reverse=True)[:3]}


def _top_sum(records: DataFrame) -> DataFrame:
    top = F.aggregate("largest", F.lit(0).cast("bigint"), lambda a, c: a + c)
    return records.select("event_type", "start_ms", "end_ms", "n", top.alias("top_cents"))


def _cents_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed_events(table(spark, sf_dir, "events"), "event_type", to_cents(F.col("value")).alias("cents"))


def window_top_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function over the elements of each window that no built-in aggregate covers."""
    events = _cents_in_time(spark, sf_dir).withColumn("ts", F.timestamp_millis("ts_ms"))
    return _top_sum(window_apply(events, "ts", WIDTH_MS, ["event_type"], _top_fold, _top_merge, TOP_SCHEMA))


def stream_window_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stream: windows as the watermark passes them, and those left open at its end."""
    arriving, out = _arriving(spark, "stream_window_apply", _cents_in_time(spark, sf_dir), "seq", LATE_SLICES)
    keys = ["event_type"]
    sink = apply_table(out, keys, _top_fold, _top_merge, TOP_SCHEMA, WIDTH_MS, bound_ms=DAY_MS)
    sinks.run_to_end(arriving, sink, f"{out}/checkpoint")
    fired = read_kind(spark, out, "main")
    return _top_sum(fired.unionByName(open_records(spark, out, keys, _top_merge, TOP_SCHEMA, WIDTH_MS)))


def stream_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of a stream, summed from panes."""
    events = _timed_events(table(spark, sf_dir, "events"), "event_type")
    arriving, out = _arriving(spark, "stream_sliding_count", events, "seq", LATE_SLICES)
    keys = ["event_type"]
    sinks.run_to_end(arriving, sliding_table(out, keys, WIDTH_MS, HOUR_MS, bound_ms=DAY_MS), f"{out}/checkpoint")
    return read_rows(spark, out).unionByName(open_sliding(spark, out, keys, WIDTH_MS, HOUR_MS))


def stream_group_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of a total by customer, record by record."""
    amounts = _order_amounts(table(spark, sf_dir, "orders"))
    arriving, out = _arriving(spark, "stream_group_changelog", amounts, "seq", LATE_SLICES)
    sinks.run_to_end(arriving, group_changelog_table(out, ["o_custkey"]), f"{out}/checkpoint")
    return read_rows(spark, out)


def stream_latest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregation in update mode, kept as a table of the latest row of each key."""
    amounts = _order_amounts(table(spark, sf_dir, "orders"))
    arriving, out = _arriving(spark, "stream_latest_totals", amounts, "seq", LATE_SLICES)
    totals = final_sum(arriving, "o_custkey", "amount")
    sinks.run_to_end(totals, update_table(out, ["o_custkey"]), f"{out}/checkpoint", "update")
    return read_latest(spark, out, ["o_custkey"])


def stream_refund_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refund alarm with keyed state and timers, by event time."""
    arriving, out = _arriving(spark, "stream_refund_waits", _refund_events(table(spark, sf_dir, "events")), "seq", LATE_SLICES)
    waits = refund_waits(arriving, ts_ms="ts_ms", within_ms=DAY_MS, bound="1 day", payload=("seq",))
    sinks.run_to_end(waits, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint")
    events = sinks.read_batches(spark, f"{out}/rows", "user_id bigint, kind string, at_ms bigint, seq bigint")
    return events.where(F.col("kind") == ALARM).select("seq", "user_id", F.col("at_ms").alias("ts_ms"))


def double_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of doubles with more places than decimals of six hold."""
    amounts = _order_amounts(table(spark, sf_dir, "orders"))
    parts = (F.col("amount") / F.lit(float(1 << 20))).alias("amount")
    return sum_changelog(amounts.select("seq", parts), scale=None)


QUERIES: dict[str, Query] = {
    "word_count": word_count,
    "csv_token_count": csv_token_count,
    "running_count": query_running_count,
    "running_sum": query_running_sum,
    "tumbling_count": query_tumbling_count,
    "tumbling_sum": query_tumbling_sum,
    "window_apply": query_window_apply,
    "window_first": query_window_first,
    "window_relabel_double": window_relabel_double,
    "sliding_count": sliding_count,
    "late_classify": late_classify,
    "late_side_output": late_side_output,
    "late_firings": late_firings,
    "late_main_output": late_main_output,
    "late_drop_count": late_drop_count,
    "conditional_emit": query_conditional_emit,
    "conditional_emit_by_user": conditional_emit_by_user,
    "rolling_max": rolling_max,
    "clean_orders": query_clean_orders,
    "refund_alarm": query_refund_alarm,
    "sql_group_sum": sql_group_sum,
    "csv_sink_totals": csv_sink_totals,
    "union_sum": union_sum,
    "sum_changelog": query_sum_changelog,
    "json_rows": query_json_rows,
    "timed_line_counts": timed_line_counts,
    "sql_insert_totals": sql_insert_totals,
    "stream_sql_union_total": stream_sql_union_total,
    "text_line_words": text_line_words,
    "text_running_words": text_running_words,
    "csv_unified_changelog": csv_unified_changelog,
    "stream_word_count": stream_word_count,
    "stream_tumbling_count": stream_tumbling_count,
    "stream_running_sum": query_stream_running_sum,
    "stream_running_count": stream_running_count,
    "stream_conditional_emit": query_stream_conditional_emit,
    "stream_conditional_emit_by_user": stream_conditional_emit_by_user,
    "stream_refund_alarm": query_stream_refund_alarm,
    "stream_late_side_output": stream_late_side_output,
    "stream_late_main_output": stream_late_main_output,
    "stream_sum_changelog": stream_sum_changelog,
    "stream_late_records_side": stream_late_records_side,
    "stream_late_records_main": stream_late_records_main,
    "window_top_amounts": window_top_amounts,
    "stream_window_apply": stream_window_apply,
    "stream_sliding_count": stream_sliding_count,
    "stream_group_changelog": stream_group_changelog,
    "stream_latest_totals": stream_latest_totals,
    "stream_refund_waits": stream_refund_waits,
    "double_changelog": double_changelog,
}
