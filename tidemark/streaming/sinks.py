"""Sinks. Table sinks write each micro-batch to a folder of its own and overwrite it
when the batch is run again, so a restart leaves no duplicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

Batch = Callable[[DataFrame, int], None]


def labelled_lines(path: str, label: str) -> Batch:
    """``foreachBatch`` function: every row as a line of text under a label, written by the
    executors to a folder of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shown = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in batch.columns])
        batch.select(F.concat(F.lit(label), shown)).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def preview_labelled(
    df: DataFrame, label: str, mode: str = "append", rows: int = 20
) -> DataStreamWriter:
    """Show the first ``rows`` rows of every micro-batch under a label, to look at only;
    ``labelled_lines`` writes all of them."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"{label} (batch {batch_id})")
        batch.show(rows, truncate=False)

    return df.writeStream.outputMode(mode).foreachBatch(show).queryName(label.strip(" =>"))


def write_csv(df: DataFrame, path: str) -> None:
    """Append a bounded result to a CSV table: a folder of part files, no header."""
    df.write.mode("append").csv(path)


def batch_table(path: str, partition_by: tuple[str, ...] = ()) -> Batch:
    """``foreachBatch`` function: the batch's rows as one partition of a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows written by ``batch_table``."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path).drop("batch_id")


def read_updates(spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The latest row of each key, from a table written in update mode (or complete mode).

    Includes the windows that were still open when a bounded stream ended.
    """
    table = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    rest = [c for c in table.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
    return table.groupBy(*keys).agg(last).select(*keys, "_last.*")


def run_to_end(
    df: DataFrame, sink: Batch, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything available now, then stop; raises if the query failed.

    Keyed state of aggregations has as many partitions as ``spark.sql.shuffle.partitions``
    says when the query first starts; the number stays with the checkpoint.
    """
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
