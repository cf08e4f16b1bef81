"""Streams over files against the bounded forms and the models."""

import os
import random

import models
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.records import words
from tidemark.operators.running import final_count
from tidemark.operators.windows import relabel_double, tumbling_count, with_watermark
from tidemark.plans import jobs
from tidemark.sources.lines import stream_lines
from tidemark.sources.tables import read_csv, register_table
from tidemark.streaming import sinks
from tidemark.streaming.carried import (
    alarm_table,
    changelog_table,
    emit_table,
    late_table,
    open_windows,
    read_kind,
    read_rows,
    running_sum_table,
    running_table,
)


def put(folder, name, lines, age):
    """A file ``age`` steps after the first, so that files are read in a known order."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(f"{line}\n" for line in lines))
    os.utime(path, (1_700_000_000 + age * 10, 1_700_000_000 + age * 10))


def feed(spark, folder, schema, batches):
    """A stream that reads each batch of tuples as one micro-batch."""
    for i, batch in enumerate(batches):
        put(folder, f"{i:03}.csv", [",".join(str(v) for v in r) for r in batch], i)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(str(folder))


def sliced(records, n):
    size = -(-len(records) // n)
    return [records[i : i + size] for i in range(0, len(records), size)]


def run(df, tmp_path, mode="append", sink=None):
    out = str(tmp_path / "out")
    sinks.run_to_end(df, sink or sinks.batch_table(out), str(tmp_path / "checkpoint"), mode)
    return out


def carried(spark, df, tmp_path, table):
    """Run an ordered operator over a stream and read what it wrote."""
    run(df, tmp_path, sink=table)
    return read_rows(spark, str(tmp_path / "out"))


def test_word_totals_in_complete_mode(spark, tmp_path):
    for i, lines in enumerate([["a b", "a"], ["b b"], ["c "]]):
        put(tmp_path / "in", f"{i}.txt", lines, i)
    counts = jobs.word_totals(stream_lines(spark, str(tmp_path / "in"), max_files=1), by="space")
    for mode in ("complete", "update"):
        folder = tmp_path / mode
        folder.mkdir()
        out = run(counts, folder, mode)
        assert rows(sinks.read_updates(spark, out, "word string, cnt bigint", ["word"])) == [
            ("a", 2), ("b", 3), ("c", 1),
        ]


def test_word_totals_in_update_mode(spark, tmp_path):
    for i, lines in enumerate([["a b", "a"], ["b b"]]):
        put(tmp_path / "in", f"{i}.txt", lines, i)
    counts = jobs.word_totals(stream_lines(spark, str(tmp_path / "in"), max_files=1), by="space")
    out = run(counts, tmp_path, "update")
    assert rows(sinks.read_batches(spark, out, "word string, cnt bigint")) == [
        ("a", 2), ("b", 1), ("b", 3),
    ]


def test_running_sum(spark, tmp_path, chunked):
    """One key holds a third of the rows and is cut into chunks."""
    chunked(10)
    rnd = random.Random(1)
    records = [(rnd.choice("aabc"), seq, rnd.randint(-5, 5)) for seq in range(120)]
    arriving = feed(spark, tmp_path / "in", "key string, seq bigint, v int", sliced(records, 8))
    found = carried(spark, arriving, tmp_path, running_sum_table(str(tmp_path / "out"), "key", "v"))
    expected = [(k, s, total) for k, s, total, _ in models.running(records)]
    assert rows(found, "key", "seq", "total") == sorted(expected)


def test_running_aggregates_of_missing_values(spark, tmp_path):
    batches = [[("a", 0, ""), ("b", 1, "2.5")], [("a", 2, ""), ("b", 3, ""), ("", 4, "1")], [("a", 5, "4"), ("b", 6, "-3"), ("", 7, "1")]]
    arriving = feed(spark, tmp_path / "in", "key string, seq bigint, v decimal(10,2)", batches)
    aggregates = {n: (n, F.col("v")) for n in ("sum", "max", "min")}
    found = carried(spark, arriving, tmp_path, running_table(str(tmp_path / "out"), ["key"], aggregates))
    got = {r.seq: tuple(None if x is None else float(x) for x in (r["sum"], r["max"], r["min"])) for r in found.collect()}
    none = (None, None, None)
    assert got == {
        0: none, 1: (2.5, 2.5, 2.5), 2: none, 3: (2.5, 2.5, 2.5), 4: (1, 1, 1), 5: (4, 4, 4), 6: (-0.5, 2.5, -3), 7: (2, 1, 1),
    }


def test_restart_continues_and_a_replayed_batch_leaves_no_duplicates(spark, tmp_path):
    schema = "key string, seq bigint, v int"
    table = running_sum_table(str(tmp_path / "out"), "key", "v")
    first, second = [("a", 0, 1), ("b", 1, 2)], [("a", 2, 10)]
    run(feed(spark, tmp_path / "in", schema, [first]), tmp_path, sink=table)
    # Forget that the first batch was committed: it is run again.
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    found = carried(spark, feed(spark, tmp_path / "in", schema, [first, second]), tmp_path, table)
    assert rows(found) == [("a", 0, 1, 1), ("a", 2, 10, 11), ("b", 1, 2, 2)]


def test_running_word_count_of_plain_files(spark, tmp_path):
    from test_jobs import CSV_LINES

    for i, line in enumerate(CSV_LINES):
        put(tmp_path / "in", f"{i}.txt", [line], i)
    job = jobs.stream_running_word_count(stream_lines(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"))
    found = carried(spark, job[0], tmp_path, job[1])
    assert [tuple(r) for r in found.orderBy("seq", "pos").select("word", "total").collect()] == [
        ("java", 1), ("c++", 1), ("php", 1), ("java", 2), ("spring", 1), ("hadoop", 1),
        ("scala", 1), ("c++", 2), ("jvm", 1), ("html", 1), ("php", 2),
    ]


def test_student_scores_to_the_alert_table(spark, tmp_path):
    records = [(0, "name-0", 5), (1, "name-1", 0), (2, "name-0", 19)]
    arriving = feed(spark, tmp_path / "in", "seq bigint, name string, score int", sliced(records, 2))
    job = jobs.stream_student_scores(arriving, str(tmp_path / "out"))
    assert rows(carried(spark, job[0], tmp_path, job[1]), "seq", "total") == [(0, 5), (1, 0), (2, 24)]


def test_conditional_emit(spark, tmp_path, chunked):
    chunked(10)
    rnd = random.Random(2)
    ts, records = 0, []
    for seq in range(120):
        ts += rnd.choice([0, 1, 7])
        records.append((rnd.choice(["1", "2"]), seq, ts))
    arriving = feed(spark, tmp_path / "in", "word string, seq bigint, ts_ms bigint", sliced(records, 8))
    table = emit_table(str(tmp_path / "out"), "word", horizon_ms=20)
    expected = models.emitted(records, 20, lambda key, seq: key == "1")
    assert rows(carried(spark, arriving, tmp_path, table), "word", "seq", "cnt") == sorted(expected)


def test_triggered_words(spark, tmp_path):
    lines = [(0, 0, "1"), (1, 10000, "1 x"), (2, 20000, "2"), (3, 30000, "1"), (4, 70000, "1")]
    arriving = feed(spark, tmp_path / "in", "seq bigint, ts_ms bigint, value string", sliced(lines, 3))
    job = jobs.stream_triggered_words(arriving, str(tmp_path / "out"))
    assert rows(carried(spark, job[0], tmp_path, job[1]), "ts_ms", "cnt") == [(10000, 2), (30000, 2), (70000, 1)]


def test_refund_alarm_by_event_time(spark, tmp_path, chunked):
    chunked(10)
    rnd = random.Random(3)
    ts, orders = 0, []
    for seq in range(120):
        ts += rnd.choice([0, 20_000, 50_000])
        orders.append((rnd.choice("aab"), seq, ts, rnd.choice([1, 2, 2])))
    arriving = feed(
        spark, tmp_path / "in", "user_id string, seq bigint, ts_ms bigint, state int", sliced(orders, 8)
    )
    found = carried(spark, arriving, tmp_path, alarm_table(str(tmp_path / "out"), ts_ms="ts_ms"))
    assert rows(found, "user_id", "seq") == sorted(models.alarms(orders, 60_000))


def test_order_alarms_of_plain_files(spark, tmp_path):
    from test_jobs import ORDERS

    put(tmp_path / "in", "0.txt", ORDERS[:3], 0)
    put(tmp_path / "in", "1.txt", ORDERS[3:], 1)
    job = jobs.stream_order_alarms(stream_lines(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"))
    assert rows(carried(spark, job[0], tmp_path, job[1]), "id") == [(4,), (7,)]


def test_refunds_of_two_batches_by_processing_time(spark, tmp_path):
    """Two batches are more than a millisecond apart and less than ten minutes."""
    for within_ms, expected in ((1, []), (600_000, [(1,)])):
        folder = tmp_path / str(within_ms)
        folder.mkdir()
        orders = [[("u", 0, 2)], [("u", 1, 2)]]
        arriving = feed(spark, folder / "in", "user_id string, seq bigint, state int", orders)
        found = carried(spark, arriving, folder, alarm_table(str(folder / "out"), within_ms=within_ms))
        assert rows(found, "seq") == expected


LATE_BATCHES = [
    [(0, 1000, "a", 1), (1, 2000, "a", 1), (2, 3000, "b", 1)],
    [(3, 7500, "a", 1)],
    [(4, 4000, "a", 1)],
    [(5, 9000, "a", 1)],
    [(6, 1500, "b", 1)],
]


def run_late(spark, tmp_path, batches, **options):
    arriving = feed(spark, tmp_path / "in", "seq bigint, ts_ms bigint, word string, cnt bigint", batches)
    out = str(tmp_path / "out")
    run(arriving, tmp_path, sink=late_table(out, **options))
    return [rows(read_kind(spark, out, kind), "word", "cnt", "end_ms") for kind in ("main", "late")]


def test_late_windows_documented_sample(spark, tmp_path):
    main, late = run_late(spark, tmp_path, LATE_BATCHES)
    assert late == [("b", 1, 5000)]
    assert main == [("a", 1, 5000), ("a", 1, 5000), ("b", 1, 5000)]
    # The window that ends at 10000 is still open when the input ends.
    assert rows(open_windows(spark, str(tmp_path / "out"), 4)) == [("a", 1, 10000)]


def test_records_years_behind_reach_the_side_output(spark, tmp_path):
    year = 365 * 24 * 3_600_000
    batches = [[(0, 60 * year, "a", 1)], [(1, 60 * year + 60_000, "a", 2), (2, 0, "a", 3), (3, -60_000, "b", 4)], [(4, 5, "a", 5)]]
    main, late = run_late(spark, tmp_path, batches, first=False)
    assert late == [("a", 3, 5000), ("a", 5, 5000), ("b", 4, -55_000)]
    left = rows(open_windows(spark, str(tmp_path / "out"), 2, first=False), "cnt")
    assert sum(c for _, c, _ in main + late) + sum(c for (c,) in left) == 15


@pytest.mark.parametrize("first", [True, False])
def test_late_windows(spark, tmp_path, first):
    rnd = random.Random(4)
    records = [
        (seq, max(0, seq * 300 - rnd.choice([0, 0, 1000, 4000, 9000])), rnd.choice("ab"), rnd.randint(1, 9))
        for seq in range(90)
    ]
    batches = sliced(records, 6)
    main, late = run_late(spark, tmp_path, batches, first=first, lateness_ms=3000)
    expected = models.late_batches(batches, 5000, 2000, 3000, first)
    assert (main, late) == expected
    assert main and late


def test_changelog_across_batches(spark, tmp_path):
    rnd = random.Random(6)
    amounts = [(seq, rnd.choice([None, 0.0, 0.1, 2.5, -0.1])) for seq in range(40)]
    amounts[0] = (0, None)
    text = [(s, "" if a is None else a) for s, a in amounts]
    arriving = feed(spark, tmp_path / "in", "seq bigint, amount double", sliced(text, 5))
    run(arriving, tmp_path, sink=changelog_table(str(tmp_path / "out")))
    found = read_rows(spark, str(tmp_path / "out"))
    exact = [(s, None if a is None else round(a * 10)) for s, a in amounts]
    tenths = F.round(F.col("total") * 10).cast("bigint").alias("total")
    got = sorted(
        (tuple(r) for r in found.select("seq", "ord", "op", tenths).collect()), key=lambda r: r[:2]
    )
    assert got == models.changelog(exact)


@pytest.mark.parametrize("kind, amount", [("int", 2_000_000_000), ("decimal(10,2)", "99999999.99")])
def test_totals_beyond_the_range_of_their_input(spark, tmp_path, kind, amount):
    arriving = feed(spark, tmp_path / "in", f"seq bigint, amount {kind}", [[(i, amount)] for i in range(4)])
    found = carried(spark, arriving, tmp_path, changelog_table(str(tmp_path / "out")))
    assert found.agg(F.max("total")).first()[0] == 4 * __import__("decimal").Decimal(str(amount))


def test_changelog_of_a_sql_union_of_registered_tables(spark, tmp_path):
    """The declared tables have no number of their own: files give the order of arrival."""
    put(tmp_path / "bounded", "o.csv", ["o1,10"], 0)
    put(tmp_path / "arriving", "o.csv", ["o2,5.5"], 1)
    for side in ("bounded", "arriving"):
        register_table(spark, f"j14_{side}", jobs.AMOUNT_SCHEMA, "csv", streaming=True, path=str(tmp_path / side))
    union = spark.sql("SELECT seq, amount FROM j14_bounded UNION ALL SELECT seq, amount FROM j14_arriving")
    job = jobs.stream_unified_changelog(union, str(tmp_path / "out"))
    found = carried(spark, job[0], tmp_path, job[1])
    assert [tuple(r) for r in found.orderBy("seq", "ord").select("op", "total").collect()] == [("+I", 10.0), ("-U", 10.0), ("+U", 15.5)]


def test_unified_stream_total(spark, tmp_path):
    """A stream and a bounded side, the bounded side read as a file stream."""
    put(tmp_path / "bounded", "o.csv", ["o1,10"], 0)
    put(tmp_path / "arriving", "o.csv", ["o2,5.5"], 0)
    sides = [
        read_csv(spark, str(tmp_path / side), jobs.AMOUNT_SCHEMA, streaming=True)
        for side in ("bounded", "arriving")
    ]
    out = run(jobs.unified_amounts(*sides).groupBy().agg(F.sum("amount").alias("t")), tmp_path, "complete")
    assert rows(sinks.read_batches(spark, out, "t double")) == [(15.5,)]


def test_sql_over_streaming_tables(spark, tmp_path):
    for side in ("bounded", "arriving"):
        put(tmp_path / side, "o.csv", ["o1,10"], 0)
        register_table(
            spark, side, jobs.AMOUNT_SCHEMA, "csv", streaming=True, path=str(tmp_path / side)
        )
    totals = spark.sql(
        "SELECT SUM(amount) AS t FROM (SELECT amount FROM bounded UNION ALL SELECT amount FROM arriving)"
    )
    out = run(totals, tmp_path, "complete")
    assert rows(sinks.read_batches(spark, out, "t double")) == [(20.0,)]


def timed_stream(spark, tmp_path):
    batches = [[(0, "a b"), (1000, "a")], [(4999, "b"), (5000, "a")], [(12000, "a a"), (25000, "z")]]
    return feed(spark, tmp_path / "in", "ms bigint, value string", batches).select(
        "value", F.timestamp_millis("ms").alias("ts")
    )


def test_window_counts_of_closed_windows(spark, tmp_path):
    arriving = with_watermark(timed_stream(spark, tmp_path))
    out = run(jobs.words_per_window(arriving), tmp_path)
    schema = "word string, window_start timestamp, window_end timestamp, cnt bigint"
    found = sinks.read_batches(spark, out, schema)
    assert rows(found.select("word", F.unix_seconds("window_start"), "cnt")) == [
        ("a", 0, 2), ("a", 5, 1), ("a", 10, 2), ("b", 0, 2),
    ]


def test_doubled_words(spark, tmp_path):
    arriving = with_watermark(timed_stream(spark, tmp_path))
    out = run(jobs.doubled_words(arriving), tmp_path)
    assert rows(sinks.read_batches(spark, out, "word string, cnt bigint")) == [
        ("合计", 4), ("合计", 4), ("合计", 6),
    ]


def test_sliding_windows(spark, tmp_path):
    arriving = with_watermark(timed_stream(spark, tmp_path))
    found = jobs.words_per_sliding_window(arriving).select("word", "cnt")
    out = run(found, tmp_path)
    words_b = sinks.read_batches(spark, out, "word string, cnt bigint").where("word = 'b'")
    assert rows(words_b, "cnt") == [(1,)] * 8 + [(2,)]


def test_windows_by_ingest_time(spark, tmp_path):
    put(tmp_path / "in", "0.txt", ["a b", "a"], 0)
    counts = jobs.stream_words_per_window(stream_lines(spark, str(tmp_path / "in")))
    out = run(counts.select("word", "cnt"), tmp_path, "update")
    assert rows(sinks.read_batches(spark, out, "word string, cnt bigint")) == [("a", 2), ("b", 1)]


def test_timed_word_sums(spark, tmp_path):
    put(tmp_path / "in", "0.txt", ["1000,a", "2000,a", "3000,b"], 0)
    put(tmp_path / "in", "1.txt", ["7000,a"], 1)
    put(tmp_path / "in", "2.txt", ["20000,z"], 2)
    sums = jobs.stream_timed_word_sums(stream_lines(spark, str(tmp_path / "in"), max_files=1))
    out = run(sums.select("word", "cnt"), tmp_path)
    assert rows(sinks.read_batches(spark, out, "word string, cnt bigint")) == [
        ("a", 1), ("a", 2), ("b", 1),
    ]


def test_late_word_windows_of_plain_files(spark, tmp_path):
    for i, batch in enumerate(LATE_BATCHES):
        put(tmp_path / "in", f"{i}.txt", [f"{ts},{w}" for _, ts, w, _ in batch], i)
    out = str(tmp_path / "out")
    job = jobs.stream_late_word_windows(stream_lines(spark, str(tmp_path / "in"), 1), out)
    run(job[0], tmp_path, sink=job[1])
    assert rows(read_kind(spark, out, "late"), "word", "cnt") == [("b", 1)]


def test_labelled_lines_hold_every_row(spark, tmp_path):
    put(tmp_path / "in", "0.txt", [f"w{i}" for i in range(50)], 0)
    counts = final_count(words(stream_lines(spark, str(tmp_path / "in"))), "word")
    out = run(counts, tmp_path, "complete", sinks.labelled_lines(str(tmp_path / "out"), "counts ======= "))
    assert rows(spark.read.text(out).select("value")) == sorted((f"counts ======= w{i},1",) for i in range(50))


def test_preview_labelled(spark, tmp_path, capsys):
    put(tmp_path / "in", "0.txt", ["a"], 0)
    counts = final_count(words(stream_lines(spark, str(tmp_path / "in"))), "word")
    writer = sinks.preview_labelled(counts, "counts ======= ", "complete")
    query = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.name == "counts"
    assert "counts ======= " in capsys.readouterr().out


def test_relabel_on_a_stream_keeps_streaming(spark, tmp_path):
    put(tmp_path / "in", "0.csv", ["0,a"], 0)
    arriving = with_watermark(timed_stream(spark, tmp_path))
    assert relabel_double(tumbling_count(words(arriving), "ts", "10 seconds", ["word"])).isStreaming


def test_large_micro_batches_have_a_file_for_every_core(spark, monkeypatch):
    from tidemark.plans import catalog

    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 10)
    rows = spark.range(-7, 393).withColumnRenamed("id", "seq")
    arriving, out = catalog._arriving(spark, "many_files", rows, "seq", 4)
    batches = []
    catalog.sinks.run_to_end(arriving, lambda df, _: batches.append(tuple(df.selectExpr("min(seq)", "max(seq)", "count(*)").first())), f"{out}/checkpoint")
    assert batches == [(-7 + 100 * i, 92 + 100 * i, 100) for i in range(4)]
    files = spark.read.parquet(f"{out.removesuffix('/out')}/in").inputFiles()
    assert len(files) == 4 * max(catalog.FILES, min(10, spark.sparkContext.defaultParallelism))
