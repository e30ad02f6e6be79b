"""Checkpoints: what was observed, camera health, busiest and fastest checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.columns import SPEED_BANDS, lenient_seconds, safe_int, speed_band
from roadlens.operators.sizing import is_small
from roadlens.sinks import store


#: The column that says for how many passages a counted row stands.
COUNT = "passage_count"


def counted(passages: DataFrame) -> DataFrame:
    """One row per checkpoint, camera and speed, with the number of its passages.

    All functions here that count take these rows as well as passages, so that several results share one pass over the
    fact. Rows are bounded by the cameras times the speeds.
    """
    return passages.groupBy("monitor_id", "camera_id", safe_int("speed").alias("speed_kmh")).agg(
        F.count("*").alias(COUNT), F.max("area_id").alias("area_id")
    )


def _passages(rows: DataFrame, when: Column | None = None) -> Column:
    """The number of passages in a group of passages or of counted rows."""
    one = F.col(COUNT) if COUNT in rows.columns else F.lit(1)
    return F.coalesce(F.sum(one if when is None else F.when(when, one)), F.lit(0))


def _speed(rows: DataFrame) -> Column:
    return F.col("speed_kmh") if COUNT in rows.columns else safe_int("speed")


def _seen(passages: DataFrame) -> DataFrame:
    """One row per camera that saw something. All later steps work on these few rows, not on passages."""
    return passages.groupBy("monitor_id", "camera_id").agg(
        _passages(passages).alias("n"), F.max("area_id").alias("area_id")
    )


def observed(passages: DataFrame) -> DataFrame:
    """Per checkpoint: its cameras seen, their number, and the number of passages."""
    return (
        _seen(passages)
        .groupBy("monitor_id")
        .agg(
            F.max("area_id").alias("area_id"),
            F.array_join(F.sort_array(F.collect_list("camera_id")), ",").alias("camera_ids"),
            F.count("camera_id").alias("camera_count"),
            F.sum("n").alias("car_count"),
        )
    )


def roster_by_monitor(roster: DataFrame) -> DataFrame:
    """Per checkpoint: the cameras it should have. The count is of roster rows, the list names each camera once."""
    return (
        roster.groupBy("monitor_id", "camera_id")
        .agg(F.count("*").alias("n"))
        .groupBy("monitor_id")
        .agg(
            F.array_join(F.sort_array(F.collect_list("camera_id")), ",").alias("camera_ids"),
            F.sum("n").alias("camera_count"),
        )
    )


def roster_with_observed(roster: DataFrame, passages: DataFrame) -> DataFrame:
    """Every checkpoint of the roster with what was observed there; NULL when nothing was."""
    seen = observed(passages).select(
        "monitor_id",
        F.col("camera_ids").alias("seen_camera_ids"),
        F.col("camera_count").alias("seen_camera_count"),
        "car_count",
    )
    return roster_by_monitor(roster).join(seen, "monitor_id", "left")


def monitor_health(roster: DataFrame, passages: DataFrame, rule: str = "count") -> DataFrame:
    """Per checkpoint of the roster: is it normal, how many of its cameras are, and which are missing.

    ``rule="count"``: normal when as many cameras were seen as the roster lists, whichever they are.
    ``rule="set"``: normal when every listed camera was seen and no other.
    """
    if rule not in ("count", "set"):
        raise ValueError(f"unknown rule {rule!r}")
    seen = _seen(passages).select("monitor_id", "camera_id", F.lit(True).alias("was_seen"))
    listed = roster.groupBy("monitor_id", "camera_id").agg(F.count("*").alias("n"))
    both = listed.join(seen, ["monitor_id", "camera_id"], "full")
    missing = F.col("n").isNotNull() & F.col("was_seen").isNull()
    per_monitor = both.groupBy("monitor_id").agg(
        F.sum("n").alias("listed"),
        F.count("was_seen").alias("seen"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(F.col("n").isNull()).alias("unlisted"),
        F.array_join(F.sort_array(F.collect_list(F.when(missing, F.col("camera_id")))), ",").alias("missing_ids"),
    )
    equal = F.col("listed") == F.col("seen")
    if rule == "set":
        equal = (F.col("missing") == 0) & (F.col("unlisted") == 0)
    per_monitor = per_monitor.where(F.col("listed").isNotNull()).withColumn("normal", equal)
    return per_monitor.select(
        "monitor_id",
        "normal",
        F.when(F.col("normal"), F.col("seen")).otherwise(F.col("listed") - F.col("missing")).alias("normal_cameras"),
        F.when(F.col("normal"), F.lit(0)).otherwise(F.col("missing")).cast("bigint").alias("abnormal_cameras"),
        F.when(~F.col("normal") & (F.col("missing") > 0), F.col("missing_ids")).alias("abnormal_camera_ids"),
    )


def abnormal_monitors(health: DataFrame) -> DataFrame:
    """The checkpoints with missing cameras and the ids of those cameras."""
    return health.where(F.col("abnormal_camera_ids").isNotNull()).select(
        "monitor_id", "abnormal_cameras", "abnormal_camera_ids"
    )


def monitor_state(health: DataFrame) -> DataFrame:
    """One summary row: normal and abnormal checkpoints and cameras, and the text 'm:c1,c2~m:c3' of missing ones.

    The text names roster entries only, so it is bounded by the roster; ``abnormal_monitors`` has it as rows.
    """
    entry = "concat(monitor_id, ':', abnormal_camera_ids)"
    return health.agg(
        F.count_if("normal").alias("normal_monitor_count"),
        F.coalesce(F.sum("normal_cameras"), F.lit(0)).alias("normal_camera_count"),
        F.count_if(~F.col("normal")).alias("abnormal_monitor_count"),
        F.coalesce(F.sum("abnormal_cameras"), F.lit(0)).alias("abnormal_camera_count"),
        F.coalesce(F.expr(f"listagg({entry}, '~') WITHIN GROUP (ORDER BY monitor_id)"), F.lit("")).alias(
            "abnormal_monitor_camera_infos"
        ),
    )


def top_monitors(roster: DataFrame, passages: DataFrame, top_n: int) -> DataFrame:
    """Busiest checkpoints among those the roster knows; equal counts go by monitor_id."""
    counts = passages.groupBy("monitor_id").agg(_passages(passages).alias("car_count"))
    known = counts.join(roster.select("monitor_id"), "monitor_id", "left_semi")
    return known.orderBy(F.desc("car_count"), "monitor_id").limit(top_n)


def passages_of(passages: DataFrame, monitors: DataFrame) -> DataFrame:
    """All passages at the given checkpoints. A top-n list has a known size, so Spark broadcasts it by itself."""
    return passages.join(monitors.select("monitor_id"), "monitor_id", "left_semi")


def speed_bands(passages: DataFrame) -> DataFrame:
    """Passages of each speed band per checkpoint."""
    band = speed_band(_speed(passages))
    return passages.groupBy("monitor_id").agg(
        *[_passages(passages, band == name).alias(f"{name}_count") for name, _ in SPEED_BANDS]
    )


def fastest_monitors(bands: DataFrame, top_n: int = 5) -> DataFrame:
    """Checkpoints with most high-speed passages, then medium, normal, low; then by monitor_id."""
    by = [F.desc(f"{name}_count") for name, _ in reversed(SPEED_BANDS)]
    return bands.orderBy(*by, "monitor_id").limit(top_n)


def _speed_floor(rows: DataFrame, top_n: int) -> DataFrame:
    """Per checkpoint: the speed below which no passage can be among the ``top_n`` fastest.

    From counts per speed. Where speeds without a number are among the fastest, every passage is.
    """
    faster = (
        Window.partitionBy("monitor_id")
        .orderBy(F.desc_nulls_last("speed_kmh"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.groupBy("monitor_id", _speed(rows).alias("speed_kmh"))
        .agg(_passages(rows).alias("n"))
        .withColumn("faster", F.coalesce(F.sum("n").over(faster), F.lit(0)))
        .where(F.col("faster") < top_n)
        .groupBy("monitor_id")
        .agg(F.min("speed_kmh").alias("floor"), F.bool_or(F.col("speed_kmh").isNull()).alias("every"))
    )


def fastest_passages(
    passages: DataFrame, monitors: DataFrame, top_n: int = 10, tie: tuple[str, ...] = (), counts: DataFrame | None = None
) -> DataFrame:
    """The fastest passages at each of the given checkpoints, which are a top list of a few rows.

    Passages below the speed floor of their checkpoint go before anything is sorted. The rank limit then applies
    before the shuffle as well (WindowGroupLimit), so a checkpoint with a third of all passages sends ``top_n`` rows
    per task. The floors, one row per given checkpoint, are broadcast if the list is as short as it should be. They come
    from ``counts``, the counted passages, if these are at hand.
    """
    order = Window.partitionBy("monitor_id").orderBy(
        F.desc_nulls_last("speed_kmh"), F.asc("event_sec"), F.asc("car"), *[F.asc(t) for t in tie]
    )
    with_speed = passages.withColumn("speed_kmh", safe_int("speed"))
    monitors = store.staged(monitors.select("monitor_id"), "monitors")
    floors = _speed_floor(passages_of(passages if counts is None else counts, monitors), top_n)
    if is_small(monitors):
        floors = F.broadcast(floors)
    return (
        with_speed.join(floors, "monitor_id")
        .where(F.col("every") | (F.col("speed_kmh") >= F.col("floor")))
        .withColumn("event_sec", lenient_seconds("action_time"))
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= top_n)
        .drop("speed_kmh", "event_sec", "floor", "every")
    )
