"""Ad clicks: parsing, repeated clicks, totals, blacklist. The stream jobs use these same functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.schema import CLICK_FIELDS

TOTAL_KEYS = ("click_date", "user_id", "ad_id")


def click_counts(clicks: DataFrame, batch: str = "10 seconds") -> DataFrame:
    """How often each full click record occurs within one batch interval of event time."""
    return (
        clicks.groupBy(F.window("event_ts", batch).alias("w"), *CLICK_FIELDS)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), *CLICK_FIELDS, "n")
    )


def valid_clicks(counts: DataFrame, max_repeat: int = 1) -> DataFrame:
    """Records repeated within their interval are machine clicks and go away altogether."""
    return counts.where(F.col("n") <= max_repeat)


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def click_totals(valid: DataFrame) -> DataFrame:
    """Valid clicks per day, user and ad."""
    return valid.groupBy(*TOTAL_KEYS).agg(F.count("*").alias("clicked_count"))


def day_totals(valid: DataFrame) -> DataFrame:
    """The same by day of the event as well, which lets a stream forget days its watermark has passed."""
    counts = valid.groupBy(*TOTAL_KEYS, F.window("window_start", "1 day").alias("w")).agg(F.count("*").alias("clicked_count"))
    return counts.select(*TOTAL_KEYS, F.col("w.start").alias("event_day"), "clicked_count")


def summed(day_totals: DataFrame) -> DataFrame:
    """Totals from those by day of the event."""
    return day_totals.groupBy(*TOTAL_KEYS).agg(F.sum("clicked_count").alias("clicked_count"))


def new_blacklist(totals: DataFrame, threshold: int = 50, known: DataFrame | None = None) -> DataFrame:
    """Users above the threshold for some ad and day, once each, without those already listed."""
    users = totals.where(F.col("clicked_count") > threshold).select("user_id").distinct()
    return users if known is None else without_blacklisted(users, known)


def ad_totals(
    clicks: DataFrame, blacklist: DataFrame, batch: str = "10 seconds", max_repeat: int = 1
) -> DataFrame:
    """The whole chain in batch form for a given blacklist."""
    return click_totals(valid_clicks(click_counts(without_blacklisted(clicks, blacklist), batch), max_repeat))


def user_windows(records: DataFrame, window: str = "10 seconds") -> DataFrame:
    """Each user once per interval, with the number of records.

    An aggregation rather than dropDuplicates: a stream sends every record of a user to one state partition for the
    latter, while partial counts shrink a hot user to one row per task first.
    """
    return (
        records.groupBy(F.window("event_ts", window).alias("w"), "user_id")
        .agg(F.count("*").alias("n_records"))
        .select(F.col("w.start").alias("window_start"), "user_id", "n_records")
    )


def count_users(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start").agg(F.count("*").alias("active_users"))


def active_users(records: DataFrame, window: str = "10 seconds") -> DataFrame:
    """Different users per interval."""
    return count_users(user_windows(records, window))


def user_sketches(records: DataFrame, window: str = "10 seconds", lg_config: int = 12) -> DataFrame:
    """One sketch of the users per interval, of a few kilobytes however many they are; for tables and append streams.

    Up to some hundred users a sketch is exact; beyond, its standard error is 0.83 / sqrt(2^lg_config), 1.3 % by default.
    """
    return (
        records.groupBy(F.window("event_ts", window).alias("w"))
        .agg(F.hll_sketch_agg("user_id", lg_config).alias("users"))
        .select(F.col("w.start").alias("window_start"), "users")
    )


def count_sketched_users(sketches: DataFrame, window: str | None = None) -> DataFrame:
    """Different users per interval of the sketches, or per longer ``window``: a user of several intervals counts once."""
    start = F.col("window_start") if window is None else F.window("window_start", window)["start"]
    merged = sketches.groupBy(start.alias("window_start")).agg(F.hll_union_agg("users").alias("users"))
    return merged.select("window_start", F.hll_sketch_estimate("users").alias("active_users"))
