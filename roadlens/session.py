"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution joins small shuffle partitions and splits skewed join sides. Numbers of partitions are left to
# the cluster; the advisory size keeps a shuffle partition well within a task's memory.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}
# Large stream state belongs on disk.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession, streams: bool = False) -> SparkSession:
    for key, value in {**SETTINGS, **(STREAM_SETTINGS if streams else {})}.items():
        spark.conf.set(key, value)
    return spark


def name_shared_folder(spark: SparkSession, local: str) -> None:
    """Give a local session without spark.checkpoint.dir a folder by name; sessions on a cluster have to bring theirs."""
    context = spark.sparkContext
    if context.master.split("[")[0] == "local" and not (
        spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    ):
        context.setCheckpointDir(local)


def local_session(cores: str = "*", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("roadlens")
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        # Lists of the few keys of small tables: hashing a few thousand halves the time.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
    }
    for key, value in {**SETTINGS, **defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
