"""Operators against the step-by-step models, whole and cut into many chunks."""

import random

import models
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.alarm import refund_alarm
from tidemark.operators.changelog import sum_changelog
from tidemark.operators.chunks import CHUNK, SUBCHUNK, add_chunks, plan_cuts
from tidemark.operators.emit import conditional_emit
from tidemark.operators.lateness import classify_late, firing_rows, firings
from tidemark.operators.rolling import rolling
from tidemark.operators.running import final_count, running, running_sum
from tidemark.operators.windows import sliding_sum, window_apply

# One key holds about a third of all rows.
KEYS = ["hot"] * 5 + [f"k{i}" for i in range(10)]
SIZES = [10_000_000, 40, 7]


def keyed(seed, n=1500):
    rnd = random.Random(seed)
    return [(rnd.choice(KEYS), seq, rnd.randint(-9, 9)) for seq in range(n)]


@pytest.mark.parametrize("size", SIZES)
def test_running(spark, chunked, size):
    chunked(size)
    records = keyed(1)
    df = spark.createDataFrame(records, "key string, seq bigint, v int").repartition(5)
    found = running(
        df, ["key"], ["seq"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    )
    assert rows(found, "key", "seq", "s", "m") == sorted(models.running(records))


def test_running_over_null_keys(spark, chunked):
    chunked(20)
    records = [(None if k == "hot" else k, s, v) for k, s, v in keyed(2, 400)]
    df = spark.createDataFrame(records, "key string, seq bigint, v int")
    found = running(df, ["key"], ["seq"], {"s": ("sum", F.col("v"))})
    expected = sorted((s, total) for _, s, total, _ in models.running(records))
    assert rows(found, "seq", "s") == expected


def test_running_over_nulls(spark, chunked):
    values = [(0, None), (1, None), (2, 5), (3, None), (4, 1)]
    df = spark.createDataFrame(values, "seq bigint, v int")
    for size in (10, 1):
        chunked(size)
        found = running(df, [], ["seq"], {"s": ("sum", F.col("v"))})
        assert rows(found, "seq", "s") == [(0, None), (1, None), (2, 5), (3, 5), (4, 6)]


def test_running_with_a_tied_first_order_column(spark, chunked):
    chunked(50)
    df = spark.range(3000).select(
        F.col("id").alias("seq"), F.least(F.col("id"), F.lit(500)).alias("at"), F.lit(1).alias("v")
    )
    cuts = plan_cuts(df, [], ["at", "seq"])
    assert cuts.tied == (500,)
    sizes = add_chunks(df, [], ["at", "seq"], cuts).groupBy(CHUNK, SUBCHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < 500
    found = running(df, [], ["at", "seq"], {"s": ("sum", F.col("v"))})
    assert found.where(F.col("s") != F.col("seq") + 1).count() == 0


def test_running_over_values_too_large_for_exact_cuts(spark, chunked):
    chunked(50)
    start = (1 << 60) + 1
    df = spark.range(2000).select(
        F.col("id").alias("seq"), (F.least(F.col("id"), F.lit(300)) + start).alias("at")
    )
    assert plan_cuts(df, [], ["at", "seq"]).tied == ()
    found = running(df, [], ["at", "seq"], {"s": ("sum", F.lit(1))})
    assert found.where(F.col("s") != F.col("seq") + 1).count() == 0


def test_chunks_are_small_whatever_the_key(spark, chunked):
    """A key with a third of the rows, all late in the order, is still cut evenly."""
    chunked(1000)
    df = spark.range(60_000).select(
        F.when(F.col("id") >= 40_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
        (F.col("id") * F.col("id")).alias("seq"),
    )
    cuts = plan_cuts(df, ["key"], ["seq"])
    assert len(cuts.hot) == 1
    sizes = add_chunks(df, ["key"], ["seq"], cuts).groupBy("key", CHUNK, SUBCHUNK).count()
    assert sizes.agg(F.sum("count"), F.max("count")).first()[0] == 60_000
    assert sizes.agg(F.max("count")).first()[0] < 3_000


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("seed, refunds", [(1, 0.5), (2, 0.9), (3, 1.0), (4, 0.2)])
def test_refund_alarm(spark, chunked, size, seed, refunds):
    chunked(size)
    rnd = random.Random(seed)
    ts, orders = 0, []
    for seq in range(900):
        ts += rnd.choice([0, 1, 20, 100])
        orders.append((rnd.choice(KEYS), seq, ts, 2 if rnd.random() < refunds else 1))
    df = spark.createDataFrame(orders, "user_id string, seq bigint, ts_ms bigint, state int")
    found = refund_alarm(df.repartition(5), within_ms=400)
    assert rows(found, "user_id", "seq") == sorted(models.alarms(orders, 400))


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("steps", [[0, 1, 5], [0, 0, 0, 0, 0, 0, 9]])
def test_conditional_emit(spark, chunked, size, steps):
    chunked(size)
    rnd = random.Random(5)
    ts, records = 0, []
    for seq in range(900):
        ts += rnd.choice(steps)
        records.append((rnd.choice(KEYS), seq, ts))
    df = spark.createDataFrame(records, "key string, seq bigint, ts_ms bigint")
    found = conditional_emit(df, "key", F.col("seq") % 3 != 0, horizon_ms=30)
    expected = models.emitted(records, 30, lambda key, seq: seq % 3 != 0)
    assert rows(found, "key", "seq", "cnt") == sorted(expected)


def test_conditional_emit_documented_rows(spark):
    records = [(0, "1"), (10000, "1"), (20000, "2"), (30000, "1"), (35000, "2"), (70000, "1")]
    df = spark.createDataFrame(
        [(i, ts, w) for i, (ts, w) in enumerate(records)], "seq bigint, ts_ms bigint, word string"
    )
    found = conditional_emit(df, "word", F.col("word") == "1")
    assert rows(found, "ts_ms", "cnt") == [(10000, 2), (30000, 2), (70000, 1)]


@pytest.mark.parametrize("size", [10_000_000, 3])
@pytest.mark.parametrize("width, bound, late", [(50, 20, 20), (50, 0, 0), (10, 35, 17), (50, 20, 120)])
def test_lateness(spark, chunked, size, width, bound, late):
    chunked(size)
    rnd = random.Random(width + late)
    records = [(seq, max(0, seq * 2 - rnd.choice([0, 0, 5, 40, 90, 200]))) for seq in range(800)]
    df = spark.createDataFrame(records, "seq bigint, ts_ms bigint").repartition(4)
    found = classify_late(df, "ts_ms", "seq", width, bound, late)
    expected = models.lateness(records, width, bound, late)
    assert rows(found, "seq", "end_ms", "late_class") == expected
    assert len({kind for _, _, kind in expected}) == (3 if late else 2) or late == 120


def test_lateness_of_times_before_the_epoch(spark):
    records = [(0, -7), (1, 12), (2, -3), (3, -30)]
    df = spark.createDataFrame(records, "seq bigint, ts_ms bigint")
    found = classify_late(df, "ts_ms", "seq", 10, 2, 0)
    assert rows(found, "seq", "end_ms", "late_class") == [
        (0, 0, "on_time"),
        (1, 20, "on_time"),
        (2, 0, "too_late"),
        (3, -20, "too_late"),
    ]


def test_lateness_of_nothing(spark):
    df = spark.createDataFrame([], "seq bigint, ts_ms bigint")
    assert rows(classify_late(df)) == []


def test_firing_rows_repeat_in_blocks(spark):
    df = spark.createDataFrame([("a", 5, 25_001), ("b", 5, 1), ("c", 10, 10_000)], "w string, end_ms bigint, firings bigint")
    assert rows(final_count(firing_rows(df), "w")) == [("a", 25_001), ("b", 1), ("c", 10_000)]


def test_firings_use_the_first_element(spark):
    df = spark.createDataFrame(
        [(0, "w", 10, 7, "on_time"), (1, "w", 10, 8, "allowed_late"), (2, "w", 10, 9, "too_late")],
        "seq int, word string, end_ms int, cnt int, late_class string",
    )
    assert rows(firings(df, ["word"])) == [("w", 10, 2, 7)]


@pytest.mark.parametrize("size", SIZES)
def test_sum_changelog(spark, chunked, size):
    chunked(size)
    rnd = random.Random(9)
    amounts = [(seq, rnd.choice([None, 0, 3, -3, 10])) for seq in range(500)]
    amounts[0] = (0, None)
    df = spark.createDataFrame(amounts, "seq bigint, amount bigint").repartition(3)
    assert rows(sum_changelog(df)) == models.changelog(amounts)


def test_sum_changelog_of_doubles(spark, chunked):
    amounts = [(i, 0.1) for i in range(30)]
    df = spark.createDataFrame(amounts, "seq bigint, amount double")
    for size in (100, 4):
        chunked(size)
        found = rows(sum_changelog(df))
        assert found[0] == (0, 0, "+I", 0.1)
        assert found[-1] == (29, 1, "+U", 3.0)
        assert all(a[3] == b[3] for a, b in zip(found[0::2], found[1::2]))


def test_sliding_sum(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1500), ("b", 4999)], "w string, ts_ms bigint")
    found = sliding_sum(df, "ts_ms", 2000, 1000, ["w"])
    assert rows(found) == [
        ("a", -1000, 1000, 1),
        ("a", 0, 2000, 2),
        ("a", 1000, 3000, 1),
        ("b", 3000, 5000, 1),
        ("b", 4000, 6000, 1),
    ]
    with pytest.raises(ValueError):
        sliding_sum(df, "ts_ms", 2000, 1500, ["w"])


def test_window_apply_merges_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(1000).select(
            F.when(F.col("id") % 3 == 0, "x").alias("w"),
            F.timestamp_millis(F.col("id") * 10).alias("ts"),
            F.col("id").alias("v"),
        )
        def fold(part):
            return {"n": len(part), "most": int(part["v"].max())}

        def merge(part):
            return {"n": int(part["n"].sum()), "most": int(part["most"].max())}

        found = window_apply(df, "ts", 5000, ["w"], fold, merge, "n bigint, most bigint", salts=4)
        got = {tuple(r) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {
        ("x", 0, 5000, 167, 498),
        (None, 0, 5000, 333, 499),
        ("x", 5000, 10000, 167, 999),
        (None, 5000, 10000, 333, 998),
    }


def test_order_columns_are_checked_at_every_size(spark):
    df = spark.createDataFrame([("a", "x", 1)], "key string, seq string, v int")
    with pytest.raises(TypeError, match="whole number"):
        running_sum(df, "key", "seq", "v")


def test_more_chunks_than_ten_thousand_are_not_capped(spark, chunked):
    chunked(1)
    df = spark.range(300).select(F.lit("k").alias("key"), F.col("id").alias("seq"))
    assert len(plan_cuts(df, ["key"], ["seq"]).first) > 200


def test_amounts_are_never_rounded(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1e-7), (2, 4e-7)], "seq bigint, amount double")
    with pytest.raises(Exception, match="more than 6 decimal places"):
        sum_changelog(df).collect()
    assert sum_changelog(df, scale=8).count() == 5


def test_helper_columns_are_not_overwritten(spark):
    df = spark.createDataFrame([("u", 1, 2, 0, 9)], "user_id string, seq bigint, state int, ts_ms bigint, _at int")
    with pytest.raises(ValueError, match="_at"):
        refund_alarm(df)
    with pytest.raises(ValueError, match="_at"):
        conditional_emit(df, "user_id", F.lit(True))


@pytest.mark.parametrize("size", SIZES)
def test_rolling(spark, chunked, size):
    chunked(size)
    rnd = random.Random(21)
    ts, records = -50, []
    for seq in range(300):
        ts += rnd.choice([0, 0, 1, 5, 30])
        records.append((rnd.choice(["a", "a", "b", None]), seq, ts, rnd.choice([None, *range(-9, 9)])))
    df = spark.createDataFrame(records, "key string, seq bigint, ts_ms bigint, v int").repartition(3)
    for kind, best in (("max", max), ("min", min)):
        expected = []
        for key, seq, ts, _ in records:
            inside = [v for k, s, t, v in records if k == key and s <= seq and ts - 20 < t and v is not None]
            expected.append((seq, best(inside, default=None)))
        found = rolling(df, ["key"], kind, F.col("v"), 20, "best").select("seq", "best")
        assert sorted(map(tuple, found.collect())) == expected
