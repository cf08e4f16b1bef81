"""Cutting large ordered groups into chunks, so that no task takes a whole hot key.

A running total, a "previous row" or a state machine needs its rows in arrival
order per key. Partitioned by key alone, a key that holds a third of all rows is
one task. Here such a key's rows are cut into consecutive *chunks* along the order
column; each (key, chunk) group is worked on alone, a small table of per-chunk
results (one row per hot key and chunk) gives what each chunk must start from, and
that is put back as one extra "carry" row at the head of the chunk.

Where to cut is decided from a bounded sample (``SAMPLES_PER_CHUNK`` rows a chunk).
The sample only balances the work: chunk numbers grow with the order column for
any cuts, so results are whole and exact whatever the sample said.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ROWS_PER_CHUNK, setting

# Accuracy asked of the quantiles at most; beyond it chunks are only less even.
MOST_ACCURATE = 1_000_000
SAMPLES_PER_CHUNK = 100
# A key is hot when it is estimated to hold more than this many chunks' worth of rows.
HOT_KEY_CHUNKS = 2

EXACT = 1 << 53

CHUNK, SUBCHUNK, IS_HOT = "_chunk", "_subchunk", "_hot"


def reserve(df: DataFrame, *names: str) -> None:
    """Refuse a table that has columns named like the helper columns of an operator."""
    taken = sorted({*names, CHUNK, SUBCHUNK, IS_HOT} & set(df.columns))
    if taken:
        raise ValueError(f"columns {taken} are used inside this operator: rename them")


@dataclass(frozen=True)
class Cuts:
    """Where to cut. ``hot`` holds hashes of hot keys, or None for one global group."""

    hot: tuple[int, ...] | None
    first: tuple[float, ...]
    second: tuple[float, ...] = ()
    # Values of the first order column so frequent that they are cut along the second.
    tied: tuple[int, ...] = ()


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")


def _quantiles(sample: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` inner quantiles, repeated where one value is frequent."""
    points = [i / parts for i in range(1, parts)]
    if not points:
        return []
    row = sample.agg(F.percentile_approx(column, points, min(20 * parts, MOST_ACCURATE)).alias("q")).first()
    return list(row["q"] or [])


def plan_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Cuts | None:
    """Choose cuts for ``df``, or None where every group is small enough as it is.

    ``order`` is one or two non-null integer columns. With one, its values must be
    unique; with two, many rows may share the first, and the pair must be unique.
    """
    for column in order:
        # At every size, so that a table does not fail only once it has grown.
        if not isinstance(df.schema[column].dataType, T.IntegralType):
            raise TypeError(f"order column {column} must be a whole number, such as unix_micros of a timestamp")
    per_chunk = setting(df.sparkSession, ROWS_PER_CHUNK)
    total = df.count()
    if total <= per_chunk:
        return None
    chunks = math.ceil(total / per_chunk)
    fraction = min(1.0, SAMPLES_PER_CHUNK * chunks / total)
    sample = (
        df.select(_hash(keys).alias("h"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
        .sample(fraction, seed=7)
        .persist()
    )
    try:
        hot = None
        if keys:
            least = HOT_KEY_CHUNKS * (total / chunks) * fraction
            # Each hot key has at least `least` of the sampled rows, so there are
            # at most chunks / HOT_KEY_CHUNKS of them.
            found = sample.groupBy("h").count().where(F.col("count") > least).collect()
            hot = tuple(sorted(r["h"] for r in found))
            if not hot:
                return None
            sample = sample.where(F.col("h").isin(*hot))
        first = _quantiles(sample, "o0", chunks)
        second: list[int] = []
        tied: list[int] = []
        if len(order) > 1:
            # Cut points are doubles: beyond their whole numbers no value can be singled out.
            repeated = {a for a, b in zip(first, first[1:]) if a == b}
            tied = sorted(v for v in repeated if abs(v) < EXACT)
            if tied:
                first += [t + 1 for t in tied]
                second = _quantiles(sample.where(F.col("o0").isin(*tied)), "o1", chunks)
    finally:
        sample.unpersist()
    return Cuts(
        hot,
        tuple(sorted({float(v) for v in first})),
        tuple(sorted({float(v) for v in second})),
        tuple(tied),
    )


def _bucket(df: DataFrame, column: str, points: Sequence[float], out: str) -> DataFrame:
    """Number of cut points at or below the value, found by binary search in the JVM."""
    if not points:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf, *points, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(df)


def add_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    """Add the hot flag and the chunk columns; rows of other keys stay in chunk 0."""
    hot = F.lit(True) if cuts.hot is None else _hash(keys).isin(*cuts.hot)
    out = _bucket(df.withColumn(IS_HOT, hot), order[0], cuts.first, CHUNK)
    if cuts.tied:
        out = _bucket(out, order[1], cuts.second, SUBCHUNK)
        sub = F.when(F.col(IS_HOT) & F.col(order[0]).isin(*cuts.tied), F.col(SUBCHUNK))
    else:
        sub = F.lit(0)
    return out.withColumns(
        {
            SUBCHUNK: F.coalesce(sub, F.lit(0)).cast("int"),
            CHUNK: F.when(F.col(IS_HOT), F.col(CHUNK)).otherwise(0).cast("int"),
        }
    )
