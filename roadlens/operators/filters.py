"""Filters over passages. All are plain column comparisons and reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_date(passages: DataFrame, start: str, end: str) -> DataFrame:
    """Days from start to end, both included; days compare as text."""
    return passages.where(F.col("date").between(start, end))


def by_date_and_cars(passages: DataFrame, start: str, end: str, cars: Sequence[str]) -> DataFrame:
    """The same, for the given plates only."""
    return by_date(passages, start, end).where(F.col("car").isin(list(cars)))


def by_time_and_monitors(passages: DataFrame, after: str, before: str, monitors: Sequence[str]) -> DataFrame:
    """Passages strictly between two time texts at the given checkpoints; the days they imply prune partitions."""
    t = F.col("action_time")
    passages = by_date(passages, after[:10], before[:10])
    return passages.where((t > after) & (t < before) & F.col("monitor_id").isin(list(monitors)))


def by_key_table(passages: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in another table.

    There is no broadcast hint: Spark broadcasts the key table while its known size is below
    spark.sql.autoBroadcastJoinThreshold and shuffles otherwise, with AQE splitting a skewed key.
    """
    return passages.join(wanted.select(key), key, "left_semi")
