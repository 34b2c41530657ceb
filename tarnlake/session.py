"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

MB = 1024 * 1024


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 128 * MB) -> dict[str, str]:
    """Shuffle and scan settings for a job of ``input_bytes`` on ``cores`` cores.

    The first shuffle is cut so that a partition holds about ``partition_bytes``; AQE merges what turns
    out smaller. Streaming state goes to RocksDB, so that it is not held on the JVM heap.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, 200)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(app: str = "tarnlake", master: str | None = None, input_bytes: int | None = None,
                  cores: int | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings. Told the size of the input and the number of cores, it also gets those
    of ``cluster_conf``; settings given by name go before both."""
    if input_bytes is not None and cores is not None:
        conf = cluster_conf(input_bytes, cores) | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
