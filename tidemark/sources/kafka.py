"""Kafka sources: plain string values and JSON rows.

Progress lives in the streaming checkpoint: a restarted query goes on from its own
committed offsets, and ``starting`` matters for the first start only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.arrival import kafka_arrival

MAX_OFFSETS = 5_000_000


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str | None = None,
    max_offsets: int = MAX_OFFSETS,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting or "latest",
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka(spark: SparkSession, streaming: bool = True, **options: str) -> DataFrame:
    """The raw Kafka columns; needs the spark-sql-kafka package on the class path."""
    if streaming:
        return spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return spark.read.format("kafka").options(**bounded_options(**options)).load()


def bounded_options(**options: str) -> dict[str, str]:
    """Options of a bounded read: from ``starting``, or else the earliest offset, to the end."""
    if options.get("starting") == "latest":
        raise ValueError("a bounded read from the latest offset holds nothing")
    settings = kafka_options(**{**options, "starting": options.get("starting") or "earliest"})
    settings.pop("maxOffsetsPerTrigger")
    return settings


def string_values(records: DataFrame) -> DataFrame:
    """Only the value, as a string, with the record's place and time in its topic."""
    return records.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp", kafka_arrival().alias("seq")
    )


def json_rows(records: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON values as rows of ``schema``; malformed JSON fails the job."""
    row = F.from_json(F.col(value).cast("string"), schema, {"mode": "FAILFAST"})
    if "offset" in records.columns:
        return records.select(row.alias("_row"), kafka_arrival().alias("seq")).select("_row.*", "seq")
    return records.select(row.alias("_row")).select("_row.*")
