"""Live state of the roads and matches with the watch-list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlens.functions.columns import safe_int
from roadlens.sinks import store
from roadlens.sinks.log import Log, Table
from roadlens.sources.tables import read_list
from roadlens.streaming.common import ONCE, per_batch, to_files

PANES = T.StructType(
    [
        T.StructField("pane_start", T.TimestampType()), T.StructField("monitor_id", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in ("speed_sum", "car_count", "speeds")),
    ]
)


def panes(passages: DataFrame, slide: str = "10 seconds") -> DataFrame:
    """Passages added up per checkpoint over panes of one slide, which the windows over them share."""
    return (
        passages.groupBy(F.window("event_ts", slide).alias("pane"), "monitor_id")
        .agg(
            F.sum(safe_int("speed").cast("bigint")).alias("speed_sum"), F.count("*").alias("car_count"),
            F.count(safe_int("speed")).alias("speeds"),
        )
    )


def _windows(panes: DataFrame, at: Column, window: str, slide: str) -> DataFrame:
    """The panes in each window, added up."""
    windows = panes.groupBy(F.window(at, window, slide).alias("w"), "monitor_id").agg(
        F.sum("speed_sum").alias("speed_sum"), F.sum("car_count").alias("car_count"), F.sum("speeds").alias("speeds")
    )
    return _with_mean(windows)


def road_state(passages: DataFrame, window: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Speed sum, passages and mean speed per checkpoint over a sliding window, for tables and append streams.

    Rows are added up in panes of one slide first, and only the panes are copied into the windows they belong to. A
    plain sliding window would copy every row window/slide times and keep as many states.
    """
    return _windows(panes(passages, slide), F.window_time("pane"), window, slide)


def _with_mean(windows: DataFrame) -> DataFrame:
    """The mean is over the passages whose speed is a number, NULL without any; car_count counts all."""
    mean = F.when(F.col("speeds") > 0, F.col("speed_sum").cast("double") / F.col("speeds").cast("double"))
    return windows.select(
        F.col("w.start").alias("window_start"), "monitor_id", "speed_sum", "car_count", mean.alias("mean_speed")
    )


def start_road_state(
    passages: DataFrame, path: str, checkpoint: str, window: str = "1 minute", slide: str = "10 seconds",
    delay: str = "1 minute", trigger: dict = ONCE,
) -> StreamingQuery:
    """Append every window once, when the watermark has passed it."""
    return to_files(road_state(passages.withWatermark("event_ts", delay), window, slide), path, checkpoint, trigger)


def _pane_log(spark: SparkSession, path: str) -> Log:
    return Log(spark, path, {"panes": Table(PANES, ("pane_start", "monitor_id"))})


def start_road_state_now(
    passages: DataFrame, path: str, checkpoint: str, slide: str = "10 seconds", delay: str = "1 minute",
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Keep the current value of every pane in a log, from which ``read_road_state_now`` forms the windows.

    The state has one row per pane and checkpoint, however many windows a pane is in, and a batch gives out the panes it
    changed, so windows are there while they are still open.
    """
    spark = passages.sparkSession
    _pane_log(spark, path).claim(store.run_of(spark, checkpoint))

    def update(batch: DataFrame, batch_id: int) -> None:
        log = _pane_log(batch.sparkSession, path)
        if log.done(batch_id):  # only the state is behind
            batch.write.format("noop").mode("overwrite").save()
            return
        log.commit({"panes": log.write("panes", batch)}, batch_id)

    rows = panes(passages.withWatermark("event_ts", delay), slide)
    rows = rows.select(F.col("pane.start").alias("pane_start"), *PANES.names[1:])
    return per_batch(rows, update, checkpoint, "update", trigger)


def read_road_state_now(
    spark: SparkSession, path: str, window: str = "1 minute", slide: str = "10 seconds", since: str | None = None
) -> DataFrame:
    """The current value of every window, of panes from a time on if one is given; ``slide`` is that of the panes."""
    where = None if since is None else F.col("pane_start") >= F.lit(since).cast("timestamp")
    return _windows(_pane_log(spark, path).read("panes", where=where), F.col("pane_start"), window, slide)


def start_watchlist(
    passages: DataFrame, list_path: str, path: str, checkpoint: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Passages of wanted plates. The list is read again for every batch; its file size decides on broadcasting."""
    spark = passages.sparkSession
    store.create(spark, path, passages.schema)
    store.claim(spark, path, checkpoint)

    def match(batch: DataFrame, batch_id: int) -> None:
        wanted = read_list(batch.sparkSession, list_path, "car")
        store.put(batch.join(wanted, "car", "left_semi").select(*batch.columns), path, batch_id)

    return per_batch(passages, match, checkpoint, trigger=trigger)
