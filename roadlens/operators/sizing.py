"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_000_000


def is_small(df: DataFrame, max_rows: int = MAX_ROWS) -> bool:
    """Whether there are at most ``max_rows`` rows; the count stops at the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(dimension: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Mark a dimension for broadcast if it has at most ``max_rows`` rows; else leave the join to Spark.

    For sources whose size Spark does not know, such as database tables. Runs one count that stops at the bound. File
    sources need no hint: Spark knows their size and broadcasts below spark.sql.autoBroadcastJoinThreshold.
    """
    return F.broadcast(dimension) if is_small(dimension, max_rows) else dimension
