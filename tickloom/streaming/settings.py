"""Session settings of stateful queries."""

from pyspark.sql import SparkSession

# Spark's own RocksDB state store and its changelog checkpoints.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Packed rows are large; a Python worker gets so many bytes of them at once, about.
PYTHON_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


def stateful_session(
    spark: SparkSession, partitions: int | None = None, *, idle_batches: bool = True
) -> SparkSession:
    """A session of the same application with a RocksDB state store.

    ``partitions`` is fixed for a query at its first start; unset, the session's own value holds.
    Without ``idle_batches`` there is no micro-batch without input: state with a time to live needs
    that to let a run-once query end, event-time operators need them to emit what is complete.
    """
    session = spark.newSession()
    for key, value in (STATE_STORE | PYTHON_BATCH).items():
        session.conf.set(key, value)
    partitions = partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    return session
