"""Batch outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.sources.tables import jdbc_options

# Saves the result of a name for a task.
Save = Callable[[str, int, DataFrame], None]


def for_task(result: DataFrame, task_id: int) -> DataFrame:
    """Mark result rows with the task they belong to."""
    return result.select(F.lit(task_id).cast("bigint").alias("task_id"), "*")


def append_jdbc(
    result: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
    batch_size: int = 5000, max_connections: int = 10,
) -> None:
    """Append to a database table: batched inserts from the tasks, one connection per partition."""
    options = jdbc_options(url, table, user, password, batchsize=batch_size, numPartitions=max_connections)
    result.write.format("jdbc").options(**options).mode("append").save()


def jdbc_saver(url: str, user: str | None = None, password: str | None = None) -> Save:
    return lambda name, task_id, df: append_jdbc(for_task(df, task_id), url, name, user, password)


def path_saver(folder: str) -> Save:
    """Save each result under its name, in the partition of its task. Saving again replaces that partition."""
    return lambda name, task_id, df: df.write.mode("overwrite").parquet(f"{folder}/{name}/task_id={task_id}")


def replace_table(result: DataFrame, table: str) -> None:
    result.write.mode("overwrite").saveAsTable(table)


def table_saver(database: str) -> Save:
    """Save each result as a managed table of its name, which replaces the one of an earlier run."""
    return lambda name, task_id, df: replace_table(for_task(df, task_id), f"{database}.{name}")


def write_partitioned(passages: DataFrame, path: str, max_rows_per_file: int = 5_000_000) -> None:
    """Write the fact partitioned by day, so that date ranges read only their days."""
    passages.write.mode("overwrite").partitionBy("date").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
