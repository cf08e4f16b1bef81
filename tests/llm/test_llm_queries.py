"""Every registered query of the subpackage; those that SQL can express against it."""

import pytest
from conftest import SF
from oracle import differences, duck

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_runs_over_the_whole_table(spark, name):
    table = "pages" if name == "op8_wrapper" else "documents"
    made = QUERIES[name](spark, SMALL)
    n = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if name == "op5_decontam":
        assert made.columns == ["doc_id", "item_id", "edits"]
        assert made.count() > 0
    else:
        assert made.count() == n
