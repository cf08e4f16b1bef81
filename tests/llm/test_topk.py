"""Exact top-k search against sorting all scores."""

import random
from collections import Counter
from math import floor, isfinite

import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>"
IS_QUERY = "vec_id % 20 = 0"


def model(rows, k):
    rows = [(i, [floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    made = Counter()
    for at, (query, v) in enumerate(rows):
        if query is None or query % 20:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0) for place, (i, w) in enumerate(rows) if place != at]
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            made[query, rank, None if missing else i, -score] += 1
    return made


def vectors():
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(60)]), [rng.gauss(0, 0.1) for _ in range(rng.choice([3, 3, 3, 0, 2]))]) for _ in range(200)]
    # Repeated rows of a query, one vector that a third of all rows share, and what takes no part.
    rows += [(20, [0.1, 0.2, 0.3])] * 30 + [(i, [0.5, 0.5, 0.5]) for i in range(100, 250)]
    return [*rows, (1, None), (20, [1.0, None]), (0, [float("nan")]), (40, [float("inf")]), (-20, [-3.0, -3.0, -3.0])]


@pytest.mark.parametrize(("k", "block"), [(20, topk.BLOCK), (20, 5), (1_000, topk.BLOCK)])
def test_top_k(spark, k, block):
    rows = vectors()
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"uid": F.lit(1), "copies": F.lit("x"), "v": F.lit(None)})
    assert Counter(tuple(r) for r in topk.top_k(table, IS_QUERY, k, block=block).collect()) == model(rows, k)


@pytest.mark.parametrize("size", [1.0, 1e4, 3e6])
def test_whole_numbers_of_any_size(spark, size):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, size) for _ in range(8)]) for i in range(120)]
    assert Counter(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, SCHEMA), IS_QUERY, 7).collect()) == model(rows, 7)


def test_floats_are_doubles_first(spark):
    table = spark.createDataFrame([(0, [0.1, -0.1]), (1, [0.3, 0.7])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(table, IS_QUERY).collect()] == [(0, 1, 1, 6 * 19 + -7 * 44)]


def test_beyond_whole_numbers(spark):
    table = spark.createDataFrame([(0, [1e9]), (1, [1e9])], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        topk.top_k(table, IS_QUERY)


def test_nothing_to_find(spark):
    for rows in ([], [(1, [1.0])], [(0, None)], [(0, [1.0])]):
        assert topk.top_k(spark.createDataFrame(rows, SCHEMA), IS_QUERY).collect() == []
