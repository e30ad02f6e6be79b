"""A repeatable random sample of cars, spread over the hours as the passages are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.columns import date_hour
from roadlens.operators.ordering import slice_offsets

# A sample has at most extract_num cars; up to this many are broadcast (about 50 MB), beyond it the join shuffles.
BROADCAST_CARS = 1_000_000


def hourly_cars(passages: DataFrame) -> DataFrame:
    """Each car once per hour it was seen in; passages without a time belong to no hour.

    The joins by hour would add the same condition on their own, each in its own branch; said here, all branches of a
    sample have one plan and share its shuffle.
    """
    hour = F.substring_index("date_hour", "_", -1).alias("hour")
    hours = passages.select(date_hour("action_time").alias("date_hour"), "car").where(F.col("date_hour").isNotNull()).distinct()
    return hours.select(F.substring_index("date_hour", "_", 1).alias("date"), hour, "car")


def hourly_distinct_cars(passages: DataFrame) -> DataFrame:
    return hourly_cars(passages).groupBy("date", "hour").agg(F.count("*").alias("cars"))


def hourly_share(passages: DataFrame) -> DataFrame:
    """Share of each hour in its day; a car counts once per hour. The window runs over the hours of a day."""
    return (
        hourly_distinct_cars(passages)
        .withColumn("day_cars", F.sum("cars").over(Window.partitionBy("date")))
        .withColumn("share", F.col("cars").cast("double") / F.col("day_cars").cast("double"))
    )


def sample_quota(passages: DataFrame, extract_num: int) -> DataFrame:
    """Cars to draw per hour: the day's equal part of extract_num times the hour's share, never above its cars."""
    # asking for the count as well keeps this subquery on the shuffle the main query makes, instead of a second scan
    days = hourly_distinct_cars(passages).where(F.col("cars") > 0).select(F.count_distinct("date")).scalar()
    per_day = F.floor(F.lit(extract_num) / days)
    wanted = F.floor(F.col("share") * F.col("per_day")).cast("bigint")
    return (
        hourly_share(passages)
        .withColumn("per_day", per_day)
        .withColumn("quota", F.least(wanted, F.col("cars")))
        .select("date", "hour", "cars", "day_cars", "per_day", "quota")
    )


def sample_cars(passages: DataFrame, extract_num: int, seed: int = 42) -> DataFrame:
    """Draw exactly the quota of each hour, without repetition: the cars with the smallest seeded hashes.

    An hour is cut into 256 slices by the first hash digits. Counts per slice tell which slices the quota reaches, and
    the join with these drops all other cars before the shuffle for the ranking; no task ranks more than one slice of an
    hour. Counts, quotas and the ranking share the shuffle that makes cars distinct.
    """
    text = F.concat_ws("|", F.lit(str(seed)), "date", "hour", "car")
    cars = hourly_cars(passages).withColumn("h", F.md5(text)).withColumn("head", F.substring("h", 1, 2))
    quota = sample_quota(passages, extract_num).where(F.col("quota") > 0).select("date", "hour", "quota")
    reached = (
        slice_offsets(cars, ["date", "hour"], F.col("head"))
        .select("_group", "_before", F.col("_group.date").alias("date"), F.col("_group.hour").alias("hour"))
        .join(quota, ["date", "hour"])
        .where(F.col("_before") < F.col("quota"))
        .select("_group", "_before", "quota")
    )
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("h", "car"))
    return (
        cars.withColumn("_group", F.struct("date", "hour", F.col("head").alias("_slice")))
        .join(reached, "_group")
        .withColumn("draw", F.col("_before") + rank)
        .where(F.col("draw") <= F.col("quota"))
        .select("date", "hour", "car", F.concat("date", F.lit("_"), "hour").alias("date_hour"))
    )


def passages_of_sample(passages: DataFrame, sample: DataFrame, extract_num: int) -> DataFrame:
    """All passages of the sampled cars, each once even if its car was drawn in several hours."""
    cars = sample.select("car").distinct()
    return passages.join(F.broadcast(cars) if extract_num <= BROADCAST_CARS else cars, "car", "left_semi")


def sampled_car_details(passages: DataFrame, extract_num: int, seed: int = 42) -> DataFrame:
    return passages_of_sample(passages, sample_cars(passages, extract_num, seed), extract_num)
