"""Stream inputs and the parsing of their text records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.columns import lenient_ts
from roadlens.schema import CLICK_FIELDS, PASSAGE_FIELDS


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **more: str) -> DataFrame:
    """Message values as text, with the broker's time. The Kafka connector has to be on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**more)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("event_ts"))


def parse_records(lines: DataFrame, fields: Sequence[str], sep: str = "\t", keep: Sequence[str] = ()) -> DataFrame:
    """Split text lines into columns. Lines with too few fields are left out, further fields are ignored."""
    parts = F.split("value", sep)
    return (
        lines.withColumn("_parts", parts)
        .where(F.size("_parts") >= len(fields))
        .select(*keep, *[F.col("_parts")[i].alias(f) for i, f in enumerate(fields)])
    )


def parse_passages(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Eight TAB fields; the event time is the passage's own."""
    return parse_records(lines, PASSAGE_FIELDS, keep=keep).withColumn("event_ts", lenient_ts("action_time"))


def parse_clicks(lines: DataFrame, keep: Sequence[str] = ("event_ts",)) -> DataFrame:
    """Six TAB fields. They hold only the day, so the event time comes with the line."""
    return parse_records(lines, CLICK_FIELDS, keep=keep)


def parse_active_users(lines: DataFrame, keep: Sequence[str] = ("event_ts",)) -> DataFrame:
    """SPACE-separated, the user id third."""
    return parse_records(lines, ("_1", "_2", "user_id"), " ", keep=[*keep, "value"]).select(*keep, "user_id", "value")
