"""Exact top-k search by distributed histogram selection.

Every query is scored against every row, and no index decides what is looked at. Instead
of keeping heaps, the k-th best score of each query is located by counting: each task
counts its scores in ``BINS`` bins of the range still open, the counts of all tasks are
added up, and the bin that holds the k-th score becomes the next range, until a bin is one
whole score. A last pass gives out what is above the k-th score, and of the scores equal to
it those with the smallest ids, as many as are missing.

Scores are whole, so every step is exact. A task sends on only its topmost bins up to k
scores, and only its k smallest ids among equal scores: the k-th best of all rows is never
below that of a part, so nothing that counts is left out, and a vector that a third of all
rows share costs no more than others. Queries are taken in blocks of about ``BLOCK`` (a
bound on what is broadcast: a block's vectors); each block reads the table once per round. Rows
that are equal in id and vector are scored once and counted as often as they occur.

Defined results: a vector that is missing, or that holds a missing or non-finite component, takes
no part; of vectors of unlike length the shorter one is filled up with zeros; a row without
an id is no query but a candidate, behind all others of its score; a repeated row is a candidate of
its copies, and a query as often as it occurs; an empty table, or one without queries, gives
an empty table; other columns do not take part. Components of which a score could reach
2**62 are refused, since scores are whole numbers of 64 bits.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BIN_BITS = 8
BINS = 1 << BIN_BITS
BLOCK = 16_384
# Scores a task has in memory at a time.
TILE = 2 << 20
# Vectors of a file of the prepared table; it is read by as many tasks as there are cores.
ROWS_PER_FILE = 4_096

SCHEMA = "query_id bigint, rank int, vec_id bigint, score bigint"


def prepared(vectors: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """``vec_id, v, copies``: the distinct rows with vectors of whole numbers."""
    parts = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") * scale)
    odd = F.exists("parts", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), parts.alias("parts"))
    whole = rows.filter(F.col("parts").isNotNull() & ~odd).select(
        "vec_id", F.transform("parts", lambda x: F.floor(x)).alias("v")
    )
    return whole.groupBy("vec_id", "v").agg(F.count("*").alias("copies"))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), kind)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Block:
    """Queries of one block, in order of their row numbers, and what is known of each."""

    def __init__(self, rows: pa.Table, width: int, kind: type, low: np.ndarray, k: int) -> None:
        rows = rows.sort_by("uid").combine_chunks()
        self.uid = rows["uid"].to_numpy()
        self.vec_id = rows["vec_id"].to_numpy()
        self.copies = rows["copies"].to_numpy()
        self.v = _matrix(rows["v"].combine_chunks(), width, kind)
        # The k-th score is the ``need``-th from the top of those in the range from ``low``.
        self.low = low(self.v)
        self.need = np.full(len(self.uid), k, np.int64)

    def tiles(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
        """Scores of some queries (from the given one on) against some rows of the table."""
        width, kind = self.v.shape[1], self.v.dtype.type
        for batch in batches:
            rows = _matrix(batch.column("v"), width, kind).T
            step = max(1, TILE // max(1, batch.num_rows))
            for at in range(0, len(self.uid), step):
                yield at, batch, self.v[at : at + step] @ rows

    def own(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Queries that are rows of the batch, and which."""
        uid = batch.column("uid").to_numpy()
        place = np.minimum(np.searchsorted(self.uid, uid), len(self.uid) - 1)
        (row,) = np.nonzero(self.uid[place] == uid)
        return place[row], row


def _counting(shared: object, shift: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        found = np.zeros((len(block.uid), BINS), np.int64)
        for at, batch, scores in block.tiles(batches):
            copies = batch.column("copies").to_numpy()
            queries, rows = block.own(batch)
            here = (queries >= at) & (queries < at + len(scores))
            own = (queries[here] - at, rows[here])
            bins = (scores - block.low[at : at + len(scores), None]) // (1 << shift)
            inside = (bins >= 0) & (bins < BINS)
            own_bins, own_inside = bins[own], inside[own]
            flat = (bins + np.arange(0, len(scores) * BINS, BINS)[:, None])[inside].astype(np.int64)
            weights = None if (copies == 1).all() else np.broadcast_to(copies, scores.shape)[inside]
            found[at : at + len(scores)] += np.bincount(flat, weights, len(scores) * BINS).astype(np.int64).reshape(-1, BINS)
            np.subtract.at(found, (own[0][own_inside] + at, own_bins[own_inside].astype(np.int64)), 1)
        # From the top down, as many bins as can hold the k-th score.
        from_top = np.cumsum(found[:, ::-1], axis=1)[:, ::-1]
        queries, bins = np.nonzero((found > 0) & (from_top - found < block.need[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries), pa.array(block.need[queries]), pa.array(bins), pa.array(found[queries, bins])],
            names=["q", "need", "bin", "n"],
        )

    return count


def _first(queries: np.ndarray, ids: np.ndarray, last: np.ndarray, copies: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Places of the rows with the smallest ids of each query, up to ``need`` copies."""
    order = np.lexsort((ids, last, queries))
    q, n = queries[order], copies[order]
    before = np.cumsum(n) - n
    starts = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
    before -= np.repeat(before[starts], np.diff(np.append(np.nonzero(starts)[0], len(q))))
    return order[before < need[q]]


def _selecting(shared: object) -> Callable:
    names = ["q", "query_id", "times", "vec_id", "score", "copies"]

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        tied = [np.zeros(0, np.int64) for _ in range(4)]

        def made(queries: np.ndarray, ids: np.ndarray, last: np.ndarray, copies: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(queries), pa.array(block.vec_id[queries]), pa.array(block.copies[queries]),
                 pa.array(ids, mask=last.astype(bool)), pa.array(scores.astype(np.int64)), pa.array(copies)], names=names,
            )

        for at, batch, scores in block.tiles(batches):
            ids = batch.column("vec_id").fill_null(0).to_numpy()
            last = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            low = block.low[at : at + len(scores), None]
            queries, rows = np.nonzero(scores >= low)
            values = scores[queries, rows]
            queries = queries + at
            copies = batch.column("copies").to_numpy()[rows] - (batch.column("uid").to_numpy()[rows] == block.uid[queries])
            above = (values > block.low[queries]) & (copies > 0)
            if above.any():
                yield made(queries[above], ids[rows[above]], last[rows[above]], copies[above], values[above])
            equal = (values == block.low[queries]) & (copies > 0)
            new = (queries[equal], ids[rows[equal]], last[rows[equal]], copies[equal])
            tied = [np.concatenate(pair) for pair in zip(tied, new, strict=True)]
            kept = _first(*tied, block.need)
            tied = [column[kept] for column in tied]
        yield made(*tied, block.low[tied[0]])

    return select


def _search(table: DataFrame, block: Block, k: int, shift: int) -> DataFrame:
    """The k best rows of each query of a block."""
    context = table.sparkSession.sparkContext
    down = Window.partitionBy("q").orderBy(F.desc("bin"))
    while shift >= 0:
        shared = context.broadcast(block)
        counts = table.mapInArrow(_counting(shared, shift), "q bigint, need bigint, bin bigint, n bigint")
        placed = counts.groupBy("q", "need", "bin").agg(F.sum("n").alias("n")).withColumn("down", F.sum("n").over(down))
        found = placed.filter("down >= need AND down - n < need").select("q", "bin", (F.col("down") - F.col("n")).alias("above")).toArrow()
        shared.destroy()
        q, bins, above = (found[c].to_numpy() for c in ("q", "bin", "above"))
        # Of a query with fewer candidates than k, all are above the lowest score of all.
        fewer = np.setdiff1d(np.arange(len(block.uid)), q)
        block.low[q] += bins * (1 << shift)
        block.need[q] -= above
        block.low[fewer] -= 1
        block.need[fewer] = np.maximum(block.need[fewer], 0)
        shift -= BIN_BITS
    rows = table.mapInArrow(
        _selecting(context.broadcast(block)), "q bigint, query_id bigint, times bigint, vec_id bigint, score bigint, copies bigint"
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("before", F.coalesce(F.sum("copies").over(best), F.lit(0))).filter(F.col("before") < k)
    spread = ranked.withColumn("rank", F.explode(F.expr(f"sequence(before + 1, least(before + copies, {k}L))")))
    return spread.withColumn("time", F.explode(F.expr("sequence(1L, times)"))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def top_k(
    vectors: DataFrame, is_query: str, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of each query by inner product
    of ``floor(scale * x)``, ties to the smaller id. ``is_query`` is a condition on ``vec_id``, in SQL."""
    spark = vectors.sparkSession
    folder = f"{shared_dir(spark)}/topk-{uuid.uuid4().hex}"
    # Row numbers are written, so that every round sees the same.
    numbered = prepared(vectors, vec_id, vector, scale).select(F.monotonically_increasing_id().alias("uid"), "*")
    numbered.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{folder}/rows")
    table = spark.read.parquet(f"{folder}/rows")
    queries = table.filter(F.col("vec_id").isNotNull() & F.expr(is_query))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    width, longest = table.agg(F.max(F.size("v")), F.max(squares)).first()
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], SCHEMA)
    # No score, nor any part of its sum, is beyond the longest vector's product with itself.
    if longest >= 1 << 62:
        raise ValueError("scores of these vectors can be beyond 64 bits")
    # Doubles while every partial sum is exact, for they are multiplied several times as fast.
    kind = np.float64 if longest < 1 << 52 else np.int64
    reach = int(np.sqrt(longest) * (1 + 1e-9)) + 1

    def low(v: np.ndarray) -> np.ndarray:
        """A score below all of a query's, by the lengths of the vectors."""
        lengths = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        return -(np.floor(lengths * reach).astype(np.int64) + 1)

    blocks = -(-n_queries // block)
    made = []
    for part in range(blocks):
        of_block = queries.filter(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == part)
        held = of_block.toArrow()
        if not held.num_rows:
            continue
        state = Block(held, width, kind, low, k)
        shift = 0
        while -2 * int(state.low.min()) + 2 > BINS << shift:
            shift += BIN_BITS
        found = _search(table, state, k, shift)
        if blocks > 1:
            found.write.parquet(f"{folder}/found-{part}")
            found = spark.read.parquet(f"{folder}/found-{part}")
        made.append(found)
    return reduce(DataFrame.unionAll, made)
