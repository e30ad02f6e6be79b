"""What the stream jobs share: starting queries, fresh lists per batch, bounded replays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# One pass over what is there, then stop; a service passes {"processingTime": "10 seconds"}.
ONCE = {"availableNow": True}


def to_files(rows: DataFrame, path: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Append rows to Parquet files, each exactly once: the sink's log makes readers skip files of failed attempts."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def to_console(rows: DataFrame, checkpoint: str, mode: str = "append", trigger: dict = ONCE) -> StreamingQuery:
    return (
        rows.writeStream.format("console")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def per_batch(
    rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", trigger: dict = ONCE
) -> StreamingQuery:
    """Run ``work(batch, batch_id)`` on every micro-batch. It must be idempotent by batch_id."""
    return (
        rows.writeStream.foreachBatch(work)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def closing_row(table: DataFrame, ts: str, path: str, after: str = "2 days") -> None:
    """Add one row that lies ``after`` the newest time of a finite table, all other columns NULL.

    Append mode gives out a window once the watermark has passed it, so a replay of a finite table would end with its
    last windows still open. A stream that also reads this row closes them; the row's own window stays open.
    """
    last = table.agg((F.max(ts) + F.expr(f"INTERVAL {after}")).alias(ts))
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != ts]
    last.select(ts, *others).select(*table.columns).write.mode("append").parquet(path)


def replay(spark: SparkSession, path: str, closing: str | None = None, **options: str) -> DataFrame:
    """Read one Parquet table, a file or a folder of files, as a stream, and the rows of ``closing`` with it.

    ``closing`` is a folder of the same columns that may still be empty: see ``run_closed``.
    """
    table = spark.read.parquet(path)
    files = table.inputFiles()
    if not files:
        raise ValueError(f"{path} has no files")
    stream = spark.readStream.schema(table.schema).options(**options)
    folder, _, name = path.rstrip("/").rpartition("/")
    if len(files) == 1 and files[0].endswith(f"/{name}"):  # streams read folders: of this one only that file
        rows = stream.option("pathGlobFilter", name).parquet(folder or "/")
    else:
        rows = stream.parquet(path)
    if closing is None:
        return rows
    table.limit(0).write.mode("ignore").parquet(closing)
    return rows.unionByName(spark.readStream.schema(table.schema).parquet(closing))


def run_closed(start: Callable[[], StreamingQuery], table: DataFrame, ts: str, closing: str) -> None:
    """Run a replay to its end, then once more on its checkpoint with the closing row, which so comes after all data."""
    start().awaitTermination()
    closing_row(table, ts, closing)
    start().awaitTermination()
