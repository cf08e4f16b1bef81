"""The order in which records of a source arrived.

Sources give it as one sortable struct ``seq``. All give the same fields, so that their union
can be ordered: the time (of the record, or of its file), the topic or file, the partition
or the block's place in the file, and the record's place in that.

The records of a file block have one struct between them, for a block's reader does not know how many
records stand before it. On a stream each micro-batch numbers its rows as it goes; ``in_order`` numbers
the rows of bounded tables, in two passes and without sorting them.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blocks (some 200 bytes each) whose table goes to every task; more are joined, and so
# many are not file blocks at all but records with places of their own.
FEW_BLOCKS, MOST_BLOCKS = 100_000, 4_000_000
# What orders the blocks: when their file was written, or its name.
BY = {"time": ("at", "origin", "part"), "name": ("origin", "part", "at")}


def kafka_arrival() -> Column:
    return F.struct(
        F.col("timestamp").alias("at"),
        F.col("topic").alias("origin"),
        F.col("partition").cast("bigint").alias("part"),
        F.col("offset").alias("place"),
    )


def file_arrival() -> Column:
    """For rows read from files. Those of one block are read in order by one task, and the
    ordered operators number them as they come."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_block_start").alias("part"),
        F.lit(0).cast("bigint").alias("place"),
    )


def in_order(rows: DataFrame, seq: str = "seq", by: str = "time") -> DataFrame:
    """Rows of bounded file sources with ``seq`` as the number of their arrival, from 0.

    The files come by time or by name, their rows as they stand in them. A first pass counts the
    rows of every block; the counts before a block (summed over the table of blocks, which the
    driver has had to plan in any case) and a row's place in its block are its number. ``rows`` may
    be projected, filtered or the union of several sources, but not shuffled since. Should the files be
    split otherwise in the second pass, because the cluster has changed, the job fails rather
    than number a row wrongly. Streams, and rows that have numbers already, stay as they are.
    """
    if rows.isStreaming or seq not in rows.columns or not isinstance(rows.schema[seq].dataType, T.StructType):
        return rows
    held = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != seq]).alias("row"),
        *[F.col(f"`{seq}`.{field}").alias(field) for field in BY[by]],
        F.monotonically_increasing_id().alias("at_row"),
    )
    counted = held.groupBy(*BY[by]).agg(F.min("at_row").alias("first_row"), F.count("*").alias("n"))
    counted = counted.orderBy(*BY[by]).limit(MOST_BLOCKS + 1).collect()
    if len(counted) > MOST_BLOCKS:
        raise ValueError(f"{seq} does not stand for file blocks: sort these rows by it instead")
    before = [0, *accumulate(block["n"] for block in counted)]
    numbers = [T.StructField(name, T.LongType()) for name in ("first_row", "n", "before")]
    schema = T.StructType([*(held.schema[f] for f in BY[by]), *numbers])
    blocks = rows.sparkSession.createDataFrame([(*block, b) for block, b in zip(counted, before)], schema)
    if len(counted) <= FEW_BLOCKS:
        blocks = F.broadcast(blocks)
    place = F.col("at_row") - F.col("first_row")
    # A block that is in its place here as it was when counted has exactly these places.
    changed = F.raise_error(F.lit("the files were split otherwise when they were counted: read them again")).cast("bigint")
    number = F.when((place >= 0) & (place < F.col("n")), F.col("before") + place).otherwise(changed)
    joined = held.join(blocks, list(BY[by]), "left")
    names = [F.col(f"row.`{c}`").alias(c) if c != seq else number.alias(seq) for c in rows.columns]
    return joined.select(*names)
