"""Tables with declared schemas, registered under a name for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.arrival import file_arrival
from tidemark.sources.kafka import json_rows, read_kafka


def read_csv(spark: SparkSession, path: str, schema: str, streaming: bool = False) -> DataFrame:
    """CSV files (no header) with a declared schema; malformed rows fail the job."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("mode", "FAILFAST").csv(path)


def read_json(spark: SparkSession, path: str, schema: str, streaming: bool = False) -> DataFrame:
    """Files of JSON lines with a declared schema; malformed rows fail the job."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("mode", "FAILFAST").json(path)


def register_table(
    spark: SparkSession,
    name: str,
    schema: str,
    connector: str,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """Declare a table: schema, connector (``csv``, ``json``, ``kafka``) and its options.

    Beside the declared columns a table has ``seq``, the order in which its rows arrived.
    """
    if connector in ("csv", "json"):
        read = read_csv if connector == "csv" else read_json
        table = read(spark, options["path"], schema, streaming).select("*", file_arrival().alias("seq"))
    elif connector == "kafka":
        table = json_rows(read_kafka(spark, streaming=streaming, **options), schema)
    else:
        raise ValueError(f"unknown connector {connector!r}")
    table.createOrReplaceTempView(name)
    return table


def declare_sink(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """A CSV table that SQL can ``INSERT INTO``; declared anew if the name is taken."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING csv LOCATION '{path}'")
