import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from models import split
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.records import clean_orders, timed_words, words
from tidemark.functions.text import WHITESPACE, split_commas, split_spaces
from tidemark.sources.lines import from_lines


@pytest.mark.parametrize(
    "line, by, expected",
    [
        ("", "comma", [""]),
        (",,", "comma", []),
        ("d,", "comma", ["d"]),
        (",a", "comma", ["", "a"]),
        (" a  b", "space", ["", "a", "", "b"]),
        ("   ", "space", []),
        ("", "space", [""]),
    ],
)
def test_split_edges(spark, line, by, expected):
    cut = {"comma": split_commas, "space": split_spaces}[by]
    assert from_lines(spark, [line]).select(cut(F.col("value"))).first()[0] == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab, \t\n\x0b\f\ré ", max_size=12), min_size=50, max_size=200))
def test_split_follows_the_rule(spark, lines):
    found = (
        from_lines(spark, lines)
        .select("seq", split_commas(F.col("value")), split_spaces(F.col("value")))
        .orderBy("seq")
        .collect()
    )
    for (_, commas, spaces), line in zip(found, lines):
        assert commas == split(line, ",")
        assert spaces == split(line, WHITESPACE)


def test_words_of_a_null_line(spark):
    df = spark.createDataFrame([(None,), ("a",)], "value string")
    assert rows(words(df)) == [("a", 1)]


def test_orders_are_cleaned(spark):
    lines = from_lines(
        spark,
        ["1,aaa,100,1,user1", "", " \t ", "1,a,1,2,", "2,b,-5,2,u,extra,more", "3,,1,2,u"],
    )
    assert rows(clean_orders(lines)) == [
        (0, 1, "aaa", 100, 1, "user1"),
        (4, 2, "b", -5, 2, "u"),
        (5, 3, "", 1, 2, "u"),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_numbers(spark, ansi):
    lines = from_lines(spark, ["1,a,1,2,u", "2,a,x,2,u"])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="malformed amount: x"):
            clean_orders(lines).collect()
        assert rows(clean_orders(lines, on_error="drop"), "id") == [(1,)]
        with pytest.raises(PySparkException, match="malformed ts_ms"):
            timed_words(from_lines(spark, ["abc,a"])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_timed_words(spark):
    lines = from_lines(spark, ["1000,a", "2000,b,ignored", "3000"])
    assert rows(timed_words(lines, on_error="drop"), "seq", "ts_ms", "word", "cnt") == [
        (0, 1000, "a", 1),
        (1, 2000, "b", 1),
    ]
    with pytest.raises(PySparkException, match="line without a word"):
        timed_words(lines).collect()
