"""The library's inputs, derived from the tables in a test-data folder. Work on them grows with those tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.schema import CLICK_FIELDS, PASSAGE_FIELDS

# The order of passages with equal times.
TIE = ("event_id",)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _id(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def passages_of(events: DataFrame) -> DataFrame:
    """Passages from events, plus event_id and the event time; works for streams as well."""
    k = F.get_json_object("props", "$.k").cast("int")
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return events.select(
        "event_id",
        F.substring(time, 1, 10).alias("date"),
        _id(k % 9, 4).alias("monitor_id"),
        _id(k, 5).alias("camera_id"),
        F.concat(F.lit("C"), _id(F.col("user_id"), 5)).alias("car"),
        time.alias("action_time"),
        F.floor("value").cast("int").cast("string").alias("speed"),
        (F.col("event_id") % 8 + 1).cast("string").alias("road_id"),
        _id(F.col("user_id") % 8, 2).alias("area_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
    )


def passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages_of(table(spark, folder, "events")).select("event_id", *PASSAGE_FIELDS)


def roster(spark: SparkSession, folder: str) -> DataFrame:
    """Every camera that saw something, and further ones from the suppliers: at odd checkpoints up to 0007 besides the
    seen ones, at 0009 and 0011 alone. So even checkpoints are complete, odd ones broken, and two fully silent."""
    s = F.col("s_suppkey")
    further = table(spark, folder, "supplier").select(
        _id((s * 2 + 1) % 12, 4).alias("monitor_id"), _id(s % 30 + 100, 5).alias("camera_id")
    )
    return passages(spark, folder).select("monitor_id", "camera_id").union(further).distinct()


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """All nations as areas 01, 02, …; passages of area 00 have none."""
    nation = table(spark, folder, "nation")
    return nation.select(_id(F.col("n_nationkey") + 1, 2).alias("area_id"), F.col("n_name").alias("area_name"))


def clicks_of(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("click_date"),
        F.concat(F.lit("10.0.0."), user.cast("string")).alias("ip"),
        user.cast("string").alias("user_id"),
        F.col("event_type").alias("ad_id"),
        F.concat(F.lit("P"), (user % 5).cast("string")).alias("province"),
        F.concat(F.lit("C"), (user % 20).cast("string")).alias("city"),
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return clicks_of(table(spark, folder, "events"))


def click_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks as text lines; those of ad 'error' lack the city."""
    city = F.when(F.col("ad_id") != "error", F.col("city"))
    return clicks(spark, folder).select(
        "event_id", "event_ts", F.concat_ws("\t", *[F.col(f) for f in CLICK_FIELDS[:-1]], city).alias("value")
    )


def passage_lines(spark: SparkSession, folder: str) -> DataFrame:
    return passages(spark, folder).select("event_id", F.concat_ws("\t", *PASSAGE_FIELDS).alias("value"))


def active_lines(spark: SparkSession, folder: str) -> DataFrame:
    """'day ad user' lines."""
    return clicks(spark, folder).select(
        "event_id", "event_ts", F.concat_ws(" ", "click_date", "ad_id", "user_id").alias("value")
    )


def blacklist(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in debt."""
    debt = table(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    return debt.select(F.col("c_custkey").cast("string").alias("user_id"))


def watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """Plates of suppliers in debt."""
    debt = table(spark, folder, "supplier").where(F.col("s_acctbal") < 0)
    return debt.select(F.concat(F.lit("C"), _id(F.col("s_suppkey"), 5)).alias("car"))


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """One task per order. Tasks of pending orders have no area name."""
    one = lambda c: F.array(c.cast("string"))
    day = F.col("o_orderdate").cast("date")
    doc = F.struct(
        one(day).alias("startDate"),
        one(F.date_add(day, 7)).alias("endDate"),
        one(F.col("o_custkey") % 20).alias("topNum"),
        one(F.floor("o_totalprice").cast("bigint")).alias("extractNum"),
        one(F.concat(F.lit("C"), _id(F.col("o_custkey"), 5))).alias("cars"),
        F.array(F.lit("0000,0001,0002"), F.lit("unused")).alias("roadFlow"),
        F.when(F.col("o_orderstatus") != "P", one(F.col("o_orderpriority"))).alias("areaName"),
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("task_id"), F.to_json(doc).alias("task_param")
    )
