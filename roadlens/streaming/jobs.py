"""The stream jobs: from text lines to stored results, each with its queries started together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.sources.streams import parse_active_users, parse_clicks, parse_passages
from roadlens.streaming import clicks, road
from roadlens.streaming.common import ONCE, to_console


def read_text_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of text files that are put into a folder; the time of a line is that of its file."""
    lines = spark.readStream.format("text").options(**options).load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("event_ts"))


def roads(
    lines: DataFrame, out: str, checkpoint: str, watchlist: str | None = None, trigger: dict = ONCE, show: bool = False
) -> list[StreamingQuery]:
    """Road state, and with a watch-list the passages of wanted plates. ``show`` prints the windows as well."""
    passages = parse_passages(lines)
    started = [road.start_road_state(passages, f"{out}/road_state", f"{checkpoint}/road_state", trigger=trigger)]
    if watchlist:
        started.append(road.start_watchlist(passages, watchlist, f"{out}/wanted", f"{checkpoint}/wanted", trigger))
    if show:
        state = road.road_state(passages.withWatermark("event_ts", "1 minute"))
        started.append(to_console(state, f"{checkpoint}/console", trigger=trigger))
    return started


def ad_clicks(
    lines: DataFrame, out: str, checkpoint: str, blacklist: str, threshold: int = 50, trigger: dict = ONCE
) -> list[StreamingQuery]:
    """Valid clicks, and from their files the totals and the growing blacklist, which are one log at ``blacklist``.

    A single pass takes the two one after the other, so that the totals have all the valid clicks.
    """
    spark = lines.sparkSession
    first = clicks.start_valid_clicks(parse_clicks(lines), f"{out}/valid", f"{checkpoint}/valid", trigger=trigger)
    if "availableNow" in trigger:
        first.awaitTermination()
    valid = clicks.read_valid_clicks(spark, f"{out}/valid")
    return [first, clicks.start_totals(valid, blacklist, f"{checkpoint}/totals", threshold, trigger)]


def users(
    lines: DataFrame, out: str, checkpoint: str, blacklist: str, trigger: dict = ONCE
) -> list[StreamingQuery]:
    """Active users that the blacklist does not have when their interval is given out."""
    records = parse_active_users(lines)
    return [
        clicks.start_active_users(
            records, f"{out}/active_users", f"{checkpoint}/active_users", trigger=trigger, blacklist_path=blacklist
        )
    ]
