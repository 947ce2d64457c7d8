"""Session settings the library is written for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

TIME_ZONE = "spark.sql.session.timeZone"
START_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Runtime settings; all of them can be changed on a live session.
RUNTIME_CONF = {
    # One hot key may hold a large share of a table: let AQE split its join
    # partition, also where that costs one more exchange further up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows take some thirty times their bytes in a shuffle once they are in a hash table.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    TIME_ZONE: "UTC",
}

STREAMING_CONF = {
    # Keyed state may exceed the heap; the RocksDB provider ships with Spark.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commit the changes of a micro-batch instead of whole snapshots of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Not one look-up more for each write, to count rows.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # All stores of an executor share one block cache and one bound of write buffers.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # A restart needs the last batch and the one before; older states would take more disk than the newest.
    "spark.sql.streaming.minBatchesToRetain": "2",
    # One RocksDB instance per join partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Text grows tenfold when it is read, and more when it is parsed; the row groups of a topic are smaller than this.
    "spark.sql.files.maxPartitionBytes": "16m",
    # The slowest branch of a union holds the watermark back.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}

# For queries whose state is known to fit the heap, as in a replay in slices: a third of the time for a row.
HEAP_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    ),
    # The format that does without column families, which only RocksDB has.
    "spark.sql.streaming.join.stateFormatVersion": "2",
    # The state of the last batch only, not that of the batch before as well.
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    # A restart reads what is left of a slice, not again all that came and went since the tenth batch before.
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "2s",
}


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def configure(spark: SparkSession, time_zone: str | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    ``time_zone`` sets the zone of all days and windows; without it the session's own stays.
    ``shuffle_bytes`` is the size of the largest shuffle to expect.  It sets how many
    partitions a shuffle starts with, so that one fits in memory; AQE joins those
    that turn out small.  100 TB of logs with a tenth of their columns in a shuffle
    start with some 40,000.
    """
    for key, value in RUNTIME_CONF.items():
        if key != TIME_ZONE:
            spark.conf.set(key, value)
    if time_zone is not None:
        spark.conf.set(TIME_ZONE, time_zone)
    if shuffle_bytes is not None:
        least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        partitions = max(least, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        spark.conf.set(START_PARTITIONS, str(partitions))
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None, heap_state: bool = False) -> SparkSession:
    """A session of the same application for streaming queries, with this one's zone and settings.

    The number of shuffle partitions becomes the number of state partitions for the
    life of a query: ``state_partitions``, else the session's ``spark.sql.shuffle.partitions``.
    State is kept in RocksDB, or with ``heap_state`` in the heap.
    """
    session = spark.newSession()
    for key in (*RUNTIME_CONF, START_PARTITIONS, "spark.sql.shuffle.partitions"):
        value = spark.conf.get(key, None)
        if value is not None:
            session.conf.set(key, value)
    for key, value in {**STREAMING_CONF, **(HEAP_STATE_CONF if heap_state else {})}.items():
        session.conf.set(key, value)
    if state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A small local session, as used by the tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python line of every column costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RUNTIME_CONF, **STREAMING_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is missing and the
    session runs in one process; executors of their own are refused one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _made:
        _made[application] = tempfile.mkdtemp(prefix="sparkmart-")
    return _made[application]
