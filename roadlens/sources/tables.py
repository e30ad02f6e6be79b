"""Batch inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table when the name is one, else files of the given format (a path has a slash or a scheme)."""
    if "/" in source:
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def read_passages(spark: SparkSession, source: str = "monitor_flow_action", fmt: str = "parquet") -> DataFrame:
    """The fact table. Keep it partitioned by ``date``, as sinks.tables.write_partitioned does: jobs read date ranges."""
    return read_table(spark, source, fmt)


def read_roster(spark: SparkSession, source: str = "monitor_camera_info", fmt: str = "parquet") -> DataFrame:
    return read_table(spark, source, fmt)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, **more: str) -> dict:
    options = {"url": url, "dbtable": table, "user": user, "password": password, **more}
    return {k: str(v) for k, v in options.items() if v is not None}


def read_jdbc(
    spark: SparkSession, url: str, table: str, user: str | None = None, password: str | None = None, **more
) -> DataFrame:
    """A database table. Big ones need partitionColumn, lowerBound, upperBound and numPartitions in ``more``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, user, password, **more)).load()


def read_list(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A text file with one key per line, such as the watch-list of plates."""
    key = F.trim("value")
    return spark.read.text(path).select(key.alias(name)).where(F.length(name) > 0)
