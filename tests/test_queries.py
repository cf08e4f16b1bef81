"""Every registered query against its SQL, and again cut into many small chunks."""

import pytest
from conftest import SF
from oracle import differences, duck

import __spark_entry__ as driver

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"
ORDERED = [
    "running_count", "running_sum", "late_classify", "late_side_output", "late_firings",
    "late_main_output", "late_drop_count", "conditional_emit", "conditional_emit_by_user",
    "refund_alarm", "rolling_max", "double_changelog", "sum_changelog", "stream_sum_changelog", "stream_running_count", "stream_refund_alarm",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ORDERED)
def test_query_in_chunks(spark, chunked, con, name):
    chunked(20)
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["word", "end_ms", "firings", "first_seq"]
