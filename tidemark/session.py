"""Session set-up and the settings the operators read from it."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Commit the changes of a batch, not a whole snapshot of the state.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Rows one ordered group may hold before it is cut into chunks (see operators.chunks).
ROWS_PER_CHUNK = ("spark.tidemark.rowsPerChunk", 4_000_000)
# Where a local session without spark.checkpoint.dir keeps its files.
LOCAL_DIR = "spark.tidemark.localDir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**STATE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings the queries need: UTC and the keyed state store."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    return spark


def setting(spark: SparkSession, option: tuple[str, int]) -> int:
    name, default = option
    return int(spark.conf.get(name, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = spark.conf.get(LOCAL_DIR, None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(LOCAL_DIR, folder)
    return folder
