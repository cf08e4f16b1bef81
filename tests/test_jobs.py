"""Every job on its documented sample."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.changelog import sum_changelog, total, union_sources
from tidemark.plans import jobs
from tidemark.sources.lines import from_lines, read_lines
from tidemark.sources.tables import read_csv

CSV_LINES = ["java,c++,php,java,spring", "hadoop,scala", "c++,jvm,html,php"]
ORDERS = [
    "1,aaa,100,1,user1",
    "2,bbb,200,1,user2",
    "3,ccc,300,2,user1",
    "4,ddd,400,2,user1",
    "",
    "5,ddd,400,2,user1",
    "6,bbb,200,2,user2",
    "7,bbb,400,2,user2",
]
LATE_LINES = ["1000,a", "2000,a", "3000,b", "7000,a", "4000,a", "9000,a", "1500,b"]


@pytest.mark.parametrize("size", [1000, 2])
def test_running_word_count(spark, chunked, size):
    chunked(size)
    found = jobs.running_word_count(from_lines(spark, CSV_LINES))
    assert [tuple(r) for r in found.orderBy("seq", "pos").select("word", "total").collect()] == [
        ("java", 1), ("c++", 1), ("php", 1), ("java", 2), ("spring", 1), ("hadoop", 1),
        ("scala", 1), ("c++", 2), ("jvm", 1), ("html", 1), ("php", 2),
    ]


def test_word_totals(spark, tmp_path):
    found = jobs.word_totals(from_lines(spark, CSV_LINES))
    assert dict(rows(found)) == {
        "java": 2, "c++": 2, "php": 2, "spring": 1, "hadoop": 1, "scala": 1, "jvm": 1, "html": 1,
    }
    (tmp_path / "words.txt").write_text("a,b,c\nb,c\nd,\n")
    assert rows(jobs.word_totals(read_lines(spark, str(tmp_path / "words.txt")))) == [
        ("a", 1), ("b", 2), ("c", 2), ("d", 1),
    ]
    assert rows(jobs.word_totals(from_lines(spark, ["a b", "b "]), by="space")) == [("a", 1), ("b", 2)]


def test_kafka_word_totals(spark):
    records = spark.createDataFrame(
        [(None, bytearray(b"a,b"), "t", 0, 0), (None, bytearray(b"b"), "t", 1, 0)],
        "key binary, value binary, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.current_timestamp())
    assert rows(jobs.kafka_word_totals(records)) == [("a", 1), ("b", 2)]


def test_student_scores(spark):
    students = [(0, "name-0", 5), (1, "name-1", 0), (2, "name-0", 19), (3, "name-0", 1)]
    df = spark.createDataFrame(students, "seq bigint, name string, score int")
    assert rows(jobs.student_scores(df), "seq", "name", "total") == [
        (0, "name-0", 5), (1, "name-1", 0), (2, "name-0", 24), (3, "name-0", 25),
    ]


@pytest.fixture
def timed(spark):
    lines = [(0, "a b"), (1000, "a"), (4999, "b"), (5000, "a"), (12000, "a a")]
    return spark.createDataFrame(lines, "ms bigint, value string").select(
        "value", F.timestamp_millis("ms").alias("ts")
    )


FIVE_SECONDS = [("a", 0, 2), ("a", 5, 1), ("a", 10, 2), ("b", 0, 2)]


def test_words_per_window(timed):
    found = jobs.words_per_window(timed)
    start = F.unix_seconds("window_start").alias("start")
    assert rows(found.select("word", start, "cnt")) == FIVE_SECONDS


def test_words_per_window_applied(timed):
    found = jobs.words_per_window_applied(timed)
    start = (F.col("start_ms") / 1000).cast("int").alias("start")
    assert rows(found.select("word", start, "cnt")) == FIVE_SECONDS


def test_words_per_sliding_window(timed):
    found = jobs.words_per_sliding_window(timed).where("word = 'b'")
    start = F.unix_seconds("window_start").alias("start")
    expected = [(-4 + i, 1) for i in range(4)] + [(0, 2)] + [(1 + i, 1) for i in range(4)]
    assert rows(found.select(start, "cnt")) == expected


def test_doubled_words(timed):
    assert rows(jobs.doubled_words(timed)) == [("合计", 4), ("合计", 4), ("合计", 6)]


def test_triggered_words(spark):
    lines = [(0, 0, "1"), (1, 10000, "1 x"), (2, 20000, "2"), (3, 30000, "1"), (4, 70000, "1")]
    df = spark.createDataFrame(lines, "seq bigint, ts_ms bigint, value string")
    assert rows(jobs.triggered_words(df), "ts_ms", "word", "cnt") == [
        (10000, "1", 2), (30000, "1", 2), (70000, "1", 1),
    ]


def test_timed_word_sums(spark):
    found = jobs.timed_word_sums(from_lines(spark, ["1000,a", "2000,a", "3000,b"]))
    assert rows(found, "word", "end_ms", "cnt") == [("a", 5000, 2), ("b", 5000, 1)]
    found = jobs.timed_word_sums(from_lines(spark, LATE_LINES))
    assert rows(found, "word", "end_ms", "cnt") == [("a", 5000, 2), ("a", 10000, 2), ("b", 5000, 1)]


def test_late_word_windows(spark):
    main, late = jobs.late_word_windows(from_lines(spark, LATE_LINES))
    assert rows(main) == [("a", 1), ("a", 1), ("a", 1), ("b", 1)]
    assert rows(late) == [("b", 1)]


def test_order_alarms(spark):
    lines = from_lines(spark, ORDERS).withColumn("ts_ms", F.col("seq") * 1000)
    assert rows(jobs.order_alarms(lines), "id") == [(4,), (7,)]


@pytest.mark.parametrize(
    "orders, expected",
    [
        ([(2, 0), (1, 1), (2, 2)], []),
        ([(2, 0), (2, 60_000)], []),
        ([(2, 0), (2, 59_999)], [1]),
        ([(2, 0), (2, 1), (2, 2), (2, 3)], [1, 3]),
        ([(2, 0), (2, 60_000), (2, 60_001)], [2]),
    ],
)
def test_order_alarm_cases(spark, orders, expected):
    lines = [(i, ts, f"{i},t,1,{state},u") for i, (state, ts) in enumerate(orders)]
    df = spark.createDataFrame(lines, "seq bigint, ts_ms bigint, value string")
    assert [r[0] for r in rows(jobs.order_alarms(df), "id")] == expected


def test_sales_totals(spark, tmp_path):
    source, sink = tmp_path / "input.csv", str(tmp_path / "out")
    source.write_text("1,product_A,10.5\n2,product_B,20.3\n3,product_C,15.8\n1,product_D,12.2\n2,product_A,18.7\n")
    jobs.sales_totals(spark, str(source), sink)
    found = rows(read_csv(spark, sink, "user_id int, total_amount double"))
    assert [(u, round(t, 6)) for u, t in found] == [(1, 22.7), (2, 39.0), (3, 15.8)]


def test_unified_amounts_and_changelog(spark, tmp_path):
    (tmp_path / "input_order.csv").write_text("o1,10\n")
    bounded = read_csv(spark, str(tmp_path), jobs.AMOUNT_SCHEMA)
    arriving = spark.createDataFrame([("o2", 5.5)], jobs.AMOUNT_SCHEMA)
    assert total(jobs.unified_amounts(bounded)).first()[0] == 10.0
    assert total(jobs.unified_amounts(bounded, arriving)).first()[0] == 15.5
    numbered = union_sources(
        bounded.select(F.lit(0).alias("seq"), "amount"), arriving.select(F.lit(1).alias("seq"), "amount")
    )
    assert rows(jobs.unified_changelog(numbered)) == [
        (0, 0, "+I", 10.0), (1, 0, "-U", 10.0), (1, 1, "+U", 15.5),
    ]
    unchanged = numbered.unionByName(spark.createDataFrame([(2, 0.0)], "seq int, amount double"))
    assert sum_changelog(unchanged).count() == 3
