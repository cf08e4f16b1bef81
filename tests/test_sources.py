import os
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources.arrival import in_order
from tidemark.sources.kafka import bounded_options, json_rows, kafka_options, string_values
from tidemark.sources.lines import read_lines
from tidemark.sources.tables import read_csv, register_table


def test_kafka_options():
    options = kafka_options("host:9092", "topic", group="g")
    assert options["kafka.bootstrap.servers"] == "host:9092"
    assert options["subscribe"] == "topic"
    assert options["startingOffsets"] == "latest"
    assert options["kafka.group.id"] == "g"
    assert int(options["maxOffsetsPerTrigger"]) > 0
    assert "kafka.group.id" not in kafka_options("h", "t")


def test_bounded_kafka_read_starts_where_asked():
    asked = '{"topic":{"0":5}}'
    assert bounded_options(servers="h", topic="t", starting=asked)["startingOffsets"] == asked
    assert bounded_options(servers="h", topic="t")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        bounded_options(servers="h", topic="t", starting="latest")


def kafka_records(spark, *values):
    return spark.createDataFrame(
        [(None, bytearray(v.encode()), "t", 0, i, 0) for i, v in enumerate(values)],
        "key binary, value binary, topic string, partition int, offset bigint, timestampType int",
    ).withColumn("timestamp", F.current_timestamp())


def test_string_values(spark):
    found = string_values(kafka_records(spark, "w1,w2", ""))
    assert rows(found, "offset", "value") == [(0, "w1,w2"), (1, "")]


def test_json_rows(spark):
    records = kafka_records(spark, '{"order_id": "o2", "amount": 5.5}', '{"order_id": "o3"}')
    schema = "order_id string, amount double"
    assert [tuple(r)[:2] for r in json_rows(records, schema).orderBy("seq").collect()] == [("o2", 5.5), ("o3", None)]
    with pytest.raises(PySparkException):
        json_rows(kafka_records(spark, '{"amount": "much"}'), schema).collect()


def test_register_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,2.5\n1,y,0.5\n")
    register_table(spark, "sales", "user_id int, product string, amount double", "csv", path=str(tmp_path))
    assert spark.sql("SELECT user_id, SUM(amount) FROM sales GROUP BY user_id").first()[1] == 3.0
    with pytest.raises(ValueError):
        register_table(spark, "x", "a int", "jdbc")


def test_csv_fails_on_malformed_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,much\n")
    table = read_csv(spark, str(tmp_path), "user_id int, product string, amount double")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        table.toPandas()


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_shared_dir_without_a_configured_one(spark):
    context = SimpleNamespace(getConf=dict, master="local[8]")
    unset = SimpleNamespace(sparkContext=context, conf=spark.conf)
    assert shared_dir(unset) == shared_dir(unset) != shared_dir(spark)
    context.master = "spark://host:7077"
    with pytest.raises(ValueError):
        shared_dir(unset)


@pytest.fixture
def small_splits(spark):
    """Files are read in blocks of 64 bytes, several blocks a task."""
    changed = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name in changed:
        spark.conf.unset(name)


def write_lines(folder, files):
    """Files of lines, each written a while before the one before it."""
    for i, (name, lines) in enumerate(files.items()):
        (folder / name).write_text("".join(f"{line}\n" for line in lines))
        os.utime(folder / name, (1_700_000_000 - i * 60, 1_700_000_000 - i * 60))


def test_lines_are_numbered_in_their_order(spark, tmp_path, small_splits):
    files = {f"{c}.txt": [f"{c}{i}" + "x" * (i % 40) for i in range(n)] for c, n in (("a", 57), ("b", 1), ("c", 0), ("d", 90))}
    write_lines(tmp_path, files)
    lines = read_lines(spark, str(tmp_path))
    assert lines.select("seq").distinct().count() > 20
    by_name = [line for name in sorted(files) for line in files[name]]
    assert rows(in_order(lines, by="name"), "seq", "value") == list(enumerate(by_name))
    by_time = [line for name in sorted(files, reverse=True) for line in files[name]]
    assert rows(in_order(lines), "seq", "value") == list(enumerate(by_time))


def test_a_filtered_union_is_numbered(spark, tmp_path, small_splits):
    for side in "ab":
        (tmp_path / side).mkdir()
        write_lines(tmp_path / side, {"x.csv": [f"{side}{i},{i}" for i in range(40)]})
        register_table(spark, f"numbered_{side}", "id string, v int", "csv", path=str(tmp_path / side))
    union = spark.sql("SELECT seq, id FROM numbered_a WHERE v % 3 > 0 UNION ALL SELECT seq, id FROM numbered_b WHERE v < 5")
    expected = [f"a{i}" for i in range(40) if i % 3] + [f"b{i}" for i in range(5)]
    assert rows(in_order(union, by="name"), "seq", "id") == list(enumerate(expected))


def test_numbers_do_not_outlive_other_splits(spark, tmp_path, small_splits):
    write_lines(tmp_path, {"a.txt": [f"line {i}" for i in range(100)]})
    numbered = in_order(read_lines(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    with pytest.raises(PySparkException, match="read them again"):
        numbered.collect()


def test_numbers_of_nothing(spark, tmp_path):
    assert in_order(read_lines(spark, str(tmp_path))).count() == 0
    numbered = spark.createDataFrame([(7, "a")], "seq bigint, value string")
    assert in_order(numbered) is numbered


def test_running_word_count_of_a_file(spark, tmp_path):
    write_lines(tmp_path, {"words.txt": ["java,c++", "java,", "php,java"]})
    counted = jobs.running_word_count(read_lines(spark, str(tmp_path / "words.txt")))
    assert rows(counted, "seq", "pos", "word", "total") == [
        (0, 0, "java", 1), (0, 1, "c++", 1), (1, 0, "java", 2), (2, 0, "php", 1), (2, 1, "java", 3),
    ]


def test_changelog_of_two_declared_tables(spark, tmp_path):
    for side, lines in (("first", ["o1,10"]), ("second", ["o2,5.5", "o3,"])):
        (tmp_path / side).mkdir()
        write_lines(tmp_path / side, {"o.csv": lines})
    sides = [register_table(spark, f"orders_{s}", jobs.AMOUNT_SCHEMA, "csv", path=str(tmp_path / s)) for s in ("first", "second")]
    found = jobs.unified_changelog(jobs.unified_amounts(*sides))
    assert [tuple(r) for r in found.orderBy("seq", "ord").collect()] == [
        (0, 0, "+I", 10.0), (1, 0, "-U", 10.0), (1, 1, "+U", 15.5),
    ]
