"""State of streams: written by change, whole batches only, timers, folds and panes."""

import json
import os
import random
import sys
import time
from collections import Counter
from fractions import Fraction

import models
import pandas as pd
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_streams import carried, feed, put, run, run_late, sliced

from tidemark.functions import exact
from tidemark.functions.records import REFUNDED
from tidemark.operators.changelog import sum_changelog, table_changes
from tidemark.operators.lateness import classify_late, firing_rows, firings, side_output
from tidemark.operators.running import final_sum
from tidemark.operators.windows import sliding_sum, window_apply
from tidemark.sources.lines import stream_lines
from tidemark.streaming import sinks
from tidemark.streaming.carried import (
    alarm_table,
    changelog_table,
    emit_table,
    group_changelog_table,
    late_table,
    open_windows,
    read_kind,
    read_latest,
    read_rows,
    running_sum_table,
    update_table,
)
from tidemark.streaming.state import FAN, KEPT, StateTable, last_commit, latest
from tidemark.streaming.timers import ALARM, EXPIRED, RefundWait, refund_waits
from tidemark.streaming.windowed import apply_table, open_records, open_sliding, sliding_table

# The user functions below go to the workers, which do not have this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VALUES = "key string, seq bigint, v int"


def apply(spark, table, schema, batches):
    for number, batch in enumerate(batches):
        table(spark.createDataFrame(batch, schema), number)


def cut_anywhere(records, rnd, parts):
    cuts = sorted(rnd.sample(range(1, len(records)), parts - 1))
    return [records[a:b] for a, b in zip([0, *cuts], [*cuts, len(records)])]


# --- the state table ---------------------------------------------------------------


def test_runs_are_merged_by_size_and_removed(spark, tmp_path):
    path = str(tmp_path)

    def merge(found, whole):
        return found.groupBy("k").agg(F.sum("v").alias("v"))

    for number in range(2 * FAN + 1):
        state = StateTable(spark, path, number, merge)
        state.commit(spark.createDataFrame([("a", 1), (f"b{number}", 1)], "k string, v bigint"), done=number)
    runs = json.loads((tmp_path / "commits" / str(2 * FAN)).read_text())["runs"]
    assert runs == [[0, FAN - 1], [FAN, 2 * FAN - 1], [2 * FAN, 2 * FAN]]
    state = StateTable(spark, path, 2 * FAN + 1, merge)
    assert state.values == {"done": 2 * FAN}
    assert state.rows().where("k = 'a'").count() == 3
    assert rows(merge(state.rows(), True).where("k = 'a'")) == [("a", 2 * FAN + 1)]
    # Two versions of the state are there, and nothing else.
    kept = [n for n in os.listdir(tmp_path / "commits") if n.isdigit()]
    assert sorted(kept, key=int) == [str(2 * FAN - KEPT + 1 + i) for i in range(KEPT)]
    assert len(os.listdir(tmp_path / "state")) <= len(runs) + FAN


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    table = running_sum_table(str(tmp_path), "key", "v")
    many = [(f"k{i}", i, 1) for i in range(3_000)]
    apply(spark, table, VALUES, [many, [("k5", 3_000, 1)], [("k7", 3_001, 1), ("new", 3_002, 1)]])
    written = {n: spark.read.parquet(str(tmp_path / "state" / n)).count() for n in os.listdir(tmp_path / "state")}
    assert written == {"run=0-0": 3_000, "run=1-1": 1, "run=2-2": 2}
    assert rows(read_rows(spark, str(tmp_path)).where("seq >= 3000"), "key", "total") == [("k5", 2), ("k7", 2), ("new", 1)]


def test_a_batch_that_failed_half_way_is_not_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    table = running_sum_table(path, "key", "v")
    apply(spark, table, VALUES, [[("a", 0, 1)]])

    def fail(self, changed, **values):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(StateTable, "commit", fail)
        with pytest.raises(OSError):
            table(spark.createDataFrame([("a", 1, 1)], VALUES), 1)
    assert os.path.exists(f"{path}/rows/batch_id=1")
    assert last_commit(spark, path) == 0
    assert rows(read_rows(spark, path), "seq", "total") == [(0, 1)]
    # Run again, with other rows: only these count.
    table(spark.createDataFrame([("a", 1, 5)], VALUES), 1)
    assert rows(read_rows(spark, path), "seq", "total") == [(0, 1), (1, 6)]
    with pytest.raises(ValueError, match="no state of batch 4"):
        StateTable(spark, path, 5)


def test_many_batches_equal_one(spark, tmp_path):
    rnd = random.Random(1)
    records = [(rnd.choice("aabc"), seq, rnd.randint(-5, 5)) for seq in range(40)]
    table = running_sum_table(str(tmp_path), "key", "v")
    apply(spark, table, VALUES, cut_anywhere(records, rnd, 6))
    expected = [(k, s, total) for k, s, total, _ in models.running(records)]
    assert rows(read_rows(spark, str(tmp_path)), "key", "seq", "total") == sorted(expected)


def test_emission_over_many_batches(spark, tmp_path):
    rnd = random.Random(2)
    ts, records = 0, []
    for seq in range(60):
        ts += rnd.choice([0, 1, 7, 40])
        records.append((rnd.choice(["1", "2"]), seq, ts))
    apply(spark, emit_table(str(tmp_path), "word", horizon_ms=20), "word string, seq bigint, ts_ms bigint", cut_anywhere(records, rnd, 6))
    expected = models.emitted(records, 20, lambda key, seq: key == "1")
    assert rows(read_rows(spark, str(tmp_path)), "word", "seq", "cnt") == sorted(expected)


# --- alarms ------------------------------------------------------------------------


def test_alarms_when_times_fall_back(spark, tmp_path):
    schema = "user_id string, seq bigint, ts_ms bigint, state int"
    documented = [[("A", 0, 0, 2)], [("B", 1, 70_000, 1)], [("A", 2, 30_000, 2)]]
    apply(spark, alarm_table(str(tmp_path / "a"), ts_ms="ts_ms"), schema, documented)
    assert rows(read_rows(spark, str(tmp_path / "a")), "seq") == [(2,)]
    rnd = random.Random(5)
    orders = [(rnd.choice("abc"), seq, rnd.randint(0, 300_000), rnd.choice([1, 2, 2])) for seq in range(80)]
    apply(spark, alarm_table(str(tmp_path / "b"), ts_ms="ts_ms"), schema, cut_anywhere(orders, rnd, 5))
    assert rows(read_rows(spark, str(tmp_path / "b")), "user_id", "seq") == sorted(models.alarms(orders, 60_000))


def test_the_time_of_a_batch_stays(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path), "user_id string, seq bigint, state int"
    table = alarm_table(path, within_ms=10_000)
    clock = [1_000_000.0]
    monkeypatch.setattr(time, "time", lambda: clock[0])
    table(spark.createDataFrame([("u", 0, 2)], schema), 0)
    clock[0] += 9
    again = spark.createDataFrame([("u", 1, 2)], schema)
    table(again, 1)
    assert rows(read_rows(spark, path), "seq") == [(1,)]
    clock[0] += 60
    table(again, 1)
    assert rows(read_rows(spark, path), "seq") == [(1,)]


def stop_when(query, done, seconds=90):
    end = time.monotonic() + seconds
    try:
        while not done():
            assert query.isActive and time.monotonic() < end, query.exception()
            time.sleep(0.3)
    finally:
        query.stop()


def events_until(waits, tmp_path, schema, done):
    """Run by processing time, which goes on for ever, until its rows are as expected."""
    out = str(tmp_path / "out")
    query = (
        waits.writeStream.foreachBatch(sinks.batch_table(out)).option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="300 milliseconds").start()
    )

    def found():
        return os.path.exists(f"{out}/batch_id=0") and done(sinks.read_batches(waits.sparkSession, out, schema))

    stop_when(query, found)


def test_only_a_timer_ends_the_wait(spark, tmp_path):
    put(tmp_path / "in", "0.csv", ["u,0,2", "v,1,1"], 0)
    arriving = spark.readStream.schema("user_id string, seq bigint, state int").csv(str(tmp_path / "in"))
    schema = "user_id string, kind string, at_ms bigint, seq bigint"
    # No record comes after the first batch.
    waits = refund_waits(arriving, within_ms=1_500, payload=("seq",))
    events_until(waits, tmp_path, schema, lambda found: rows(found, "user_id", "kind") == [("u", EXPIRED)])


def test_waits_by_event_time_end_with_the_watermark(spark, tmp_path):
    batches = [[("a", 0, 1_000, 2)], [("b", 1, 31_000, 2)], [("c", 2, 100_000, 1)], [("d", 3, 131_000, 2)], [("d", 4, 141_000, 2)]]
    arriving = feed(spark, tmp_path / "in", "user_id string, seq bigint, ts_ms bigint, state int", batches)
    out = run(refund_waits(arriving, ts_ms="ts_ms", payload=("seq",)), tmp_path)
    found = rows(sinks.read_batches(spark, out, "user_id string, kind string, at_ms bigint, seq bigint"), "user_id", "kind", "at_ms")
    assert found == [("a", EXPIRED, 61_000), ("b", EXPIRED, 91_000), ("d", ALARM, 141_000)]


def test_waits_equal_the_bounded_alarm(spark, tmp_path):
    rnd = random.Random(7)
    ts, orders = 1, []
    for seq in range(120):
        ts += rnd.choice([0, 20_000, 50_000])
        orders.append((rnd.choice("aab"), seq, ts, rnd.choice([1, 2, 2])))
    arriving = feed(spark, tmp_path / "in", "user_id string, seq bigint, ts_ms bigint, state int", sliced(orders, 4))
    out = run(refund_waits(arriving, ts_ms="ts_ms", payload=("seq",)), tmp_path)
    found = sinks.read_batches(spark, out, "user_id string, kind string, at_ms bigint, seq bigint").where(F.col("kind") == ALARM)
    assert rows(found, "user_id", "seq") == sorted(models.alarms(orders, 60_000))


def test_waits_of_plain_files(spark, tmp_path):
    from test_jobs import ORDERS

    from tidemark.functions.records import clean_orders

    put(tmp_path / "in", "0.txt", ORDERS, 0)
    orders = clean_orders(stream_lines(spark, str(tmp_path / "in")))
    schema = "user_id string, kind string, at_ms bigint, id int"
    alarms = F.col("kind") == ALARM
    events_until(refund_waits(orders, payload=("id",)), tmp_path, schema, lambda found: rows(found.where(alarms), "id") == [(4,), (7,)])


# --- late records ------------------------------------------------------------------


@pytest.mark.parametrize(("first", "seed"), [(True, 4), (False, 5)])
def test_lateness_by_record_however_cut(spark, tmp_path, first, seed):
    rnd = random.Random(seed)
    records = [
        (seq, max(0, seq * 300 - rnd.choice([0, 0, 1000, 4000, 9000])), rnd.choice("ab"), rnd.randint(1, 9)) for seq in range(70)
    ]
    schema = "seq bigint, ts_ms bigint, word string, cnt bigint"
    out = str(tmp_path)
    apply(spark, late_table(out, lateness_ms=3000, first=first, per_record=True), schema, cut_anywhere(records, rnd, 6))
    classified = classify_late(spark.createDataFrame(records, schema), lateness_ms=3000).cache()
    assert rows(read_kind(spark, out, "late"), "word", "cnt", "end_ms") == rows(side_output(classified), "word", "cnt", "end_ms")
    flush = open_windows(spark, out, first=first)
    main = read_kind(spark, out, "main").select("word", "cnt", "end_ms").unionByName(flush)
    if first:
        expected = firing_rows(firings(classified, ["word"])).select("word", "cnt", "end_ms")
        assert rows(main) == rows(expected)
    else:
        # What a window holds at its last firing is the sum of all that reached it.
        totals = classified.where("late_class <> 'too_late'").groupBy("word", "end_ms").agg(F.sum("cnt").alias("cnt"))
        assert rows(main.groupBy("word", "end_ms").agg(F.max("cnt").alias("cnt"))) == rows(totals)
    classified.unpersist()


@pytest.mark.parametrize("per_record", [True, False])
def test_records_without_a_time_are_late(spark, tmp_path, per_record):
    schema = "seq bigint, ts_ms bigint, word string, cnt bigint"
    batches = [[(0, 1_000, "a", 1), (1, None, "a", 2)], [(2, None, "b", 3), (3, 20_000, "a", 4)]]
    apply(spark, late_table(str(tmp_path), per_record=per_record), schema, batches)
    assert rows(read_kind(spark, str(tmp_path), "late"), "word", "cnt", "end_ms") == [("a", 2, None), ("b", 3, None)]
    assert rows(read_kind(spark, str(tmp_path), "main"), "word", "cnt", "end_ms") == [("a", 1, 5_000)]
    assert rows(side_output(classify_late(spark.createDataFrame(sum(batches, []), schema))), "cnt") == [(2,), (3,)]


# --- windows -----------------------------------------------------------------------


def gaps(part):
    """Times of some elements; merged, their longest gap can be told."""
    return {"times": sorted(part["ts_ms"].dropna().astype(int).tolist())}


def merge_gaps(part):
    return {"times": sorted(t for times in part["times"] for t in times)}


def test_window_function_over_batches(spark, tmp_path):
    rnd = random.Random(8)
    records = [(seq, seq * 400 - rnd.choice([0, 900]), rnd.choice(["a", "b", None])) for seq in range(80)]
    schema, out = "seq bigint, ts_ms bigint, word string", str(tmp_path)
    table = apply_table(out, ["word"], gaps, merge_gaps, "times array<bigint>", bound_ms=1_000)
    apply(spark, table, schema, cut_anywhere(records, rnd, 5))
    columns = ["word", "start_ms", "end_ms", "times"]
    found = read_kind(spark, out, "main").select(columns).unionByName(
        open_records(spark, out, ["word"], merge_gaps, "times array<bigint>").select(columns)
    )
    df = spark.createDataFrame(records, schema).withColumn("ts", F.timestamp_millis("ts_ms"))
    expected = window_apply(df, "ts", 5_000, ["word"], gaps, merge_gaps, "times array<bigint>").select(columns)
    assert Counter(map(str, found.collect())) == Counter(map(str, expected.collect()))


def test_window_function_fires_again_for_late_records(spark, tmp_path):
    batches = [[(0, 1_000, "a")], [(1, 7_000, "a")], [(2, 2_000, "a")], [(3, 12_000, "a")], [(4, 3_000, "a"), (5, None, "b")]]
    table = apply_table(str(tmp_path), ["word"], gaps, merge_gaps, "times array<bigint>", lateness_ms=4_000)
    apply(spark, table, "seq bigint, ts_ms bigint, word string", batches)
    main = read_kind(spark, str(tmp_path), "main")
    assert sorted(map(list, main.where("start_ms = 0").select("times").toPandas()["times"]), key=len) == [[1_000], [1_000, 2_000]]
    late = {r.word: (r.start_ms, r.times) for r in read_kind(spark, str(tmp_path), "late").collect()}
    assert late["a"] == (0, [3_000]) and late["b"][0] is None


def test_sliding_windows_from_panes(spark, tmp_path):
    rnd = random.Random(9)
    records = [(seq, seq * 400 - rnd.choice([0, 900]), rnd.choice("ab"), rnd.randint(1, 9)) for seq in range(80)]
    schema, out = "seq bigint, ts_ms bigint, word string, v bigint", str(tmp_path)
    table = sliding_table(out, ["word"], 5_000, 1_000, F.col("v"), "total", bound_ms=1_000)
    apply(spark, table, schema, cut_anywhere(records, rnd, 5))
    found = read_rows(spark, out).unionByName(open_sliding(spark, out, ["word"], 5_000, 1_000, "total"))
    df = spark.createDataFrame(records, schema)
    assert rows(found) == rows(sliding_sum(df, "ts_ms", 5_000, 1_000, ["word"], F.col("v"), "total"))
    panes = df.select("word", (F.col("ts_ms") / 1_000).cast("int")).distinct().count()
    assert sum(spark.read.parquet(f"{out}/state/{n}").count() for n in os.listdir(f"{out}/state")) <= 2 * panes


# --- changelogs --------------------------------------------------------------------


class KeptRefund:
    """A user's state and timers, without a stream."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_waits_make_frames_for_alarms_only():
    """Most users have no alarm in a batch: nothing is made for them. Records are put in order, missing numbers first."""
    waits = RefundWait(["seq"], ["user_id", "kind", "at_ms", "seq"], 1, 100, True)
    kept = KeptRefund()
    waits.init(kept)

    def given(*records):
        part = pd.DataFrame([(7, seq, state, at, seq, pd.Timestamp(at, unit="ms")) for seq, state, at in records])
        return [frame.to_dict("records") for frame in waits.handleInputRows((7,), iter([part.iloc[:1], part.iloc[1:]]), None)]

    assert given((2, REFUNDED, 50), (1, 1, 10)) == []
    assert (kept.value, kept.timers) == ((50,), [150])
    assert given((4, 1, 70), (3, REFUNDED, 60)) == [[{"user_id": 7, "kind": ALARM, "at_ms": 60, "seq": 3}]]
    assert given((6, REFUNDED, 90), (None, REFUNDED, 80))[0][0]["seq"] == 6
    assert (kept.value, kept.timers) == (None, [])


def test_exact_sums_of_doubles(spark):
    rnd = random.Random(10)
    odd = [5e-324, 1e-310, 2.2250738585072014e-308, 1e16, -1e16, 0.1, 0.2, -0.1, 1 / 3, 1e-7, 1e300, -1e300, 0.0, -0.0]
    groups = [[rnd.choice(odd) if rnd.random() < 0.5 else rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(rnd.randint(1, 9))]
              for _ in range(300)]
    df = spark.createDataFrame([(g, x) for g, group in enumerate(groups) for x in group], "g int, x double").repartition(4)
    where = exact.places(df, F.col("x"))
    parts = exact.parts(F.col("x"), where)
    sums = df.groupBy("g").agg(*[F.sum(part).alias(name) for name, part in parts.items()])
    made = dict(sums.select("g", exact.total({name: F.col(name) for name in parts}, where)).collect())
    assert [made[g] for g in range(len(groups))] == [float(sum(map(Fraction, group))) for group in groups]


def test_sums_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    found = []
    for values in ([inf, 1.0], [-inf], [inf, -inf], [nan, 1.0]):
        df = spark.createDataFrame(list(enumerate(values)), "seq int, amount double")
        found.append([str(r.total) for r in sum_changelog(df, scale=None).where("op != '-U'").orderBy("seq").collect()])
    assert found == [["inf"], ["-inf"], ["inf", "nan"], ["nan"]]


@pytest.mark.parametrize("scale", [2.0**-20, 2.0**-1074, 2.0**900])
def test_sums_in_few_places(spark, scale):
    """Doubles with few bits take few places, and their totals, in one bigint or not, are right."""
    rnd = random.Random(15)
    sets = [[rnd.choice([-1, 1]) * rnd.randrange(1, 1 << rnd.choice([20, 36])) * scale for _ in range(rnd.randint(1, 9))] for _ in range(40)]
    df = spark.createDataFrame([(g, x) for g, group in enumerate(sets) for x in group], "g int, x double")
    where = exact.places(df, F.col("x"))
    assert len(where) <= 3
    parts = exact.parts(F.col("x"), where)
    sums = df.groupBy("g").agg(*[(F.sum(part) * (1 + F.col("g") % 2 * ((1 << 24) - 1))).alias(name) for name, part in parts.items()])
    made = dict(sums.select("g", exact.total({name: F.col(name) for name in parts}, where)).collect())
    factors = [((1 << 24) - 1) * (g % 2) + 1 for g in range(len(sets))]
    assert [made[g] for g in range(len(sets))] == [float(sum(map(Fraction, group)) * f) for group, f in zip(sets, factors)]


def test_totals_of_doubles_are_worked_out_in_all_tasks(spark):
    df = spark.range(100).select(F.col("id").alias("seq"), (F.col("id") / 3).alias("amount"))
    tasks = sum_changelog(df, scale=None).select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1


def doubles():
    rnd = random.Random(11)
    values = [None, 0.0, 1 / 3, 1e-7, 1e300, -1e300, 0.1, -0.1, 1e16]
    return [(seq, rnd.choice(values)) for seq in range(50)]


def check_doubles(found):
    amounts = doubles()
    entries = [tuple(r) for r in found.orderBy("seq", "ord").collect()]
    new = {seq: total for seq, _, op, total in entries if op != "-U"}
    so_far, last = None, None
    for seq, amount in amounts:
        if amount is not None:
            so_far = (so_far or Fraction()) + Fraction(amount)
        if seq in new:
            assert new[seq] == (None if so_far is None else float(so_far))
        else:
            assert so_far is None or float(so_far) == last
        last = None if so_far is None else float(so_far)
    after = [total for _, _, op, total in entries if op != "-U"]
    assert [total for _, _, op, total in entries if op == "-U"] == after[:-1]


def test_changelog_of_any_doubles(spark, chunked):
    df = spark.createDataFrame(doubles(), "seq bigint, amount double").repartition(3)
    for size in (1_000, 10):
        chunked(size)
        check_doubles(sum_changelog(df, scale=None))


def test_changelog_of_any_doubles_on_a_stream(spark, tmp_path):
    table = changelog_table(str(tmp_path))
    apply(spark, table, "seq bigint, amount double", cut_anywhere(doubles(), random.Random(12), 3))
    check_doubles(read_rows(spark, str(tmp_path)))


def replay(entries, keys=1):
    """The table a changelog leads to; each ``-U`` must name the row that is there."""
    table = {}
    for row in entries:
        key, op, value = row[:keys], row[-2], row[-1]
        if op == "-U":
            assert table[key] == value
        else:
            assert (op == "+I") == (key not in table)
            table[key] = value
    return table


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_changelog_by_key(spark, tmp_path, kind):
    rnd = random.Random(13)
    records = [(rnd.choice(["a", "b", None]), seq, rnd.choice([None, 0, 5, -5, 7])) for seq in range(60)]
    records += [("c", seq, None) for seq in range(60, 63)]
    df = spark.createDataFrame(records, "key string, seq bigint, amount bigint")
    table = group_changelog_table(str(tmp_path), ["key"])
    for number, batch in enumerate(cut_anywhere(records, rnd, 4)):
        part = spark.createDataFrame(batch, "key string, seq bigint, amount bigint")
        table(part.withColumn("amount", F.col("amount").cast(kind)), number)
    found = read_rows(spark, str(tmp_path)).orderBy("seq", "ord").select("key", "op", F.col("total").cast("bigint"))
    whole = sum_changelog(df, keys=["key"]).orderBy("seq", "ord").select("key", "op", "total")
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in whole.collect()]
    totals = {(r.key,): r.total for r in df.groupBy("key").agg(F.sum("amount").alias("total")).collect()}
    assert replay([tuple(r) for r in whole.collect()]) == totals


def test_update_table(spark, tmp_path):
    rnd = random.Random(14)
    batches = [[(rnd.choice(["a", "b", "c", ""]), seq, rnd.randint(0, 1)) for seq in range(i * 9, i * 9 + 9)] for i in range(6)]
    totals = final_sum(feed(spark, tmp_path / "in", VALUES, batches), "key", "v")
    out = str(tmp_path / "out")
    run(totals, tmp_path, "update", update_table(out, ["key"]))
    expected = Counter()
    for key, _, v in sum(batches, []):
        expected[key or None] += v
    assert dict(map(tuple, read_latest(spark, out, ["key"]).collect())) == dict(expected)
    changes = read_rows(spark, out).orderBy("batch", "ord").select("key", "op", "total")
    assert replay([tuple(r) for r in changes.collect()]) == {(k,): v for k, v in expected.items()}


def test_table_changes(spark):
    old = spark.createDataFrame([("a", 1), (None, 2), ("same", 3)], "k string, v int")
    new = spark.createDataFrame([("a", None), (None, 5), ("same", 3), ("b", 4)], "k string, v int")
    found = {(r.k, r.op): r.v for r in table_changes(old, new, ["k"]).collect()}
    assert found == {("a", "-U"): 1, ("a", "+U"): None, (None, "-U"): 2, (None, "+U"): 5, ("b", "+I"): 4}


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), (None, 3, 0)], "k string, v int, n int")
    assert {tuple(r) for r in latest(df, ["k"], "n").collect()} == {("a", 2, 1), (None, 3, 0)}
