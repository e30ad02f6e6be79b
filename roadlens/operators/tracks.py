"""Vehicle tracks, cars per checkpoint and five minutes, and companions of wanted cars."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import lenient_seconds, range_label
from roadlens.operators.ordering import HOT_ROWS, PART_ROWS, number_within, ordered_lists
from roadlens.operators.sizing import MAX_ROWS, is_small
from roadlens.sinks import store

TIE = ("monitor_id", "camera_id")
#: A hot key is sliced by the second, the finest unit of the times, so a slice holds what one second does.
SLICE_SECONDS = 1
#: Cells of the filter ahead of the join with wanted cars: some 8 MB as numbers.
CELLS = 1 << 20
#: Pairs of a passage and a wanted car in its bucket that one task joins and counts.
PAIR_ROWS = 1_000_000
#: Where and when passages meet wanted cars, and what they are counted by.
SPOT, RESULT = ("monitor_id", "bucket"), ("wanted_car", "car", "monitor_id")


def _timed(passages: DataFrame, tie: Sequence[str], *columns: str) -> DataFrame:
    return passages.select(
        *dict.fromkeys(["car", "monitor_id", *columns, *tie]), lenient_seconds("action_time").alias("event_sec")
    )


def _slice(seconds: int = SLICE_SECONDS) -> Column:
    return F.floor(F.col("event_sec") / seconds)


def _span(seconds: int = SLICE_SECONDS) -> Column:
    """So many slices in a row: the seconds of a day."""
    return F.floor(_slice(seconds) / 86400)


def in_car_order(
    passages: DataFrame, tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Number each car's passages by time; equal times go by the tie columns. A hot car is sliced by the second."""
    return number_within(_timed(passages, tie), ["car"], ["event_sec", *tie], _slice(slice_seconds), hot_rows, _span(slice_seconds))


def car_track(
    passages: DataFrame, tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS, part_rows: int = PART_ROWS
) -> DataFrame:
    """The checkpoints each car passed, 'm1,m2,…' in time order, with the date of the last of them."""
    return ordered_lists(
        _timed(passages, tie, "date"), ["car"], ["event_sec", *tie], _slice(), F.col("monitor_id"), ",", "track",
        last="date", hot_rows=hot_rows, part_rows=part_rows, span=_span(),
    )


def car_track_times(
    passages: DataFrame, tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS, part_rows: int = PART_ROWS
) -> DataFrame:
    """The same with times: 'm1=time|m2=time|…'."""
    item = F.concat("monitor_id", F.lit("="), "action_time")
    return ordered_lists(
        _timed(passages, tie, "action_time"), ["car"], ["event_sec", *tie], _slice(), item, "|", "track",
        hot_rows=hot_rows, part_rows=part_rows, span=_span(),
    )


def range_visits(passages: DataFrame, last_only: bool = True, tie: Sequence[str] = TIE, minutes: int = 5) -> DataFrame:
    """One row per visit with the label of its five-minute range: what ``monitor_5min_cars`` lists.

    ``last_only`` keeps only the last visit of a car to a checkpoint, which is what the stored result has always held.
    """
    visits = _timed(passages, tie, "action_time")
    if last_only:
        visits = (
            visits.groupBy("monitor_id", "car")
            .agg(F.max(F.struct("event_sec", *tie, "action_time")).alias("v"))
            .select("monitor_id", "car", "v.event_sec", "v.action_time", *[f"v.{t}" for t in tie if t != "monitor_id"])
        )
    return visits.withColumn("range_time", range_label("action_time", minutes))


def cars_per_range(
    visits: DataFrame, tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS, part_rows: int = PART_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Per checkpoint and range: 'car=time|car=time' by time, then car. Also renders stored and new visits together.

    ``counted`` are passages that the visits were chosen from; hot ranges are told by them.
    """
    order, item = ["event_sec", "car", *tie], F.concat("car", F.lit("="), "action_time")
    return ordered_lists(
        visits, ["monitor_id", "range_time"], order, _slice(), item, "|", "cars", hot_rows=hot_rows, part_rows=part_rows,
        span=_span(), counted=counted,
    )


def monitor_5min_cars(
    passages: DataFrame, last_only: bool = True, tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    # a last visit is one of the passages in its range, so these are counted: without the shuffle that finds the last
    counted = passages.select("monitor_id", range_label("action_time").alias("range_time")) if last_only else None
    return cars_per_range(range_visits(passages, last_only, tie), tie, hot_rows, part_rows, counted)


def companions(
    passages: DataFrame, wanted: DataFrame, gap_seconds: int = 300, broadcast_rows: int = MAX_ROWS,
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """Cars seen at the same checkpoint within ``gap_seconds`` of a wanted car, and how often.

    A passage counts once per wanted car, however often that car passed in the meantime. So the wanted side needs no
    single passages: per (wanted car, checkpoint, bucket of ``gap_seconds``) only the first and last time matter. Any
    passage in the same bucket is near; one in the next bucket is near up to last + gap, one in the previous bucket
    from first - gap on. That gives one row per wanted car and bucket, and each passage meets it once: for each wanted
    car the work is linear in the passages even when one car or one checkpoint has a third of them. Where Spark does not
    know the size of ``wanted``, pass it through sizing.broadcast_if_small.

    The buckets that wanted cars reach into are written once and counted. Up to ``broadcast_rows`` of them are broadcast,
    and no passage is shuffled for the join. More of them are hashed to ``CELLS`` cells, which bounds what is broadcast,
    and these drop the passages that meet none of them before the rest is shuffled.

    Many wanted cars at busy checkpoints make many pairs, most of them rows of the result, and a task that counts the
    pairs holds them all. So the pairs are counted by bucket first. More than ``pair_rows`` of them are dealt to as many
    tasks as hold ``pair_rows`` each, see ``_counted_in_slices``, unless all cars make few results: up to twice as many,
    since slices hold theirs twice, before and after they are combined.
    """
    timed = passages.select("monitor_id", "car", lenient_seconds("action_time").alias("event_sec")).withColumn(
        "bucket", F.floor(F.col("event_sec") / gap_seconds)
    )
    seen = (
        timed.join(wanted.select("car"), "car", "left_semi")
        .groupBy("car", "monitor_id", "bucket")
        .agg(F.min("event_sec").alias("first"), F.max("event_sec").alias("last"))
    )
    near = (
        seen.select(F.col("car").alias("wanted_car"), "monitor_id", F.explode(_reach(gap_seconds)).alias("r"))
        .groupBy("wanted_car", "monitor_id", F.col("r.bucket").alias("bucket"))
        .agg(F.max("r.until").alias("until"), F.min("r.since").alias("since"))
    )
    near = store.staged(near, "near")
    spots = store.staged(_pairs_by_spot(timed, near), "spots")
    pairs = spots.agg(F.sum("pairs")).first()[0] or 0
    if pairs > pair_rows and _results_bound(passages, near) > 2 * pair_rows:
        tasks = math.ceil((pairs + passages.count() + near.count()) / pair_rows)
        return _counted_in_slices(timed, near, spots, pair_rows, tasks)
    if is_small(near, broadcast_rows):
        reached, near = timed, F.broadcast(near)
    else:
        reached = _in_cells(timed, near)
    return _met(reached, near, SPOT).groupBy(*RESULT).agg(F.count("*").alias("n_passages"))


def _cell() -> Column:
    """The cell of a checkpoint and bucket, -1 where one is missing.

    Never NULL, so Spark doesn't take the times apart a second time to look for NULL ahead of a join.
    """
    known = F.col("monitor_id").isNotNull() & F.col("bucket").isNotNull()
    return F.coalesce(F.when(known, F.pmod(F.xxhash64(*SPOT), F.lit(CELLS))), F.lit(-1))


def _in_cells(timed: DataFrame, near: DataFrame) -> DataFrame:
    """Without the passages that meet none of the cells that wanted cars reach into."""
    cells = near.select(_cell().alias("cell")).distinct()  # at most CELLS numbers
    return timed.select("*", _cell().alias("cell")).join(F.broadcast(cells), "cell", "left_semi").drop("cell")


def _met(reached: DataFrame, near: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = F.col("event_sec")
    return reached.join(near, list(keys)).where(
        (F.col("car") != F.col("wanted_car")) & ((t <= F.col("until")) | (t >= F.col("since")))
    )


def _pairs_by_spot(timed: DataFrame, near: DataFrame) -> DataFrame:
    """Per checkpoint and bucket that wanted cars reach into, the pairs of a passage and a wanted car."""
    spot, known = F.struct(*SPOT).alias("spot"), near.dropna(subset=SPOT)  # a struct is never NULL either
    seen = _in_cells(timed, known).groupBy(spot).agg(F.count("*").alias("seen"))
    wanted = known.groupBy(spot).agg(F.count("*").alias("wanted"))
    return seen.join(wanted, "spot").select("spot.*", (F.col("seen") * F.col("wanted").cast("double")).alias("pairs"))


def _results_bound(passages: DataFrame, near: DataFrame) -> int:
    """About the most rows there can be: every car with every wanted car at each checkpoint that one was near."""
    cars = passages.agg(F.approx_count_distinct("car")).first()[0]
    return cars * near.select("wanted_car", "monitor_id").distinct().count()


def _counted_in_slices(timed: DataFrame, near: DataFrame, spots: DataFrame, pair_rows: int, tasks: int) -> DataFrame:
    """Join and count in ``tasks`` tasks, of about ``pair_rows`` pairs each.

    The passages of a checkpoint and bucket with more pairs are dealt to slices, and its wanted cars are copied to each.
    How many slices is looked up by cell, where passages that meet no wanted car leave. Pairs are counted where they are
    joined, so a hot car leaves a row per bucket and slice, and these are shuffled and summed.
    """
    keys = [*SPOT, "slice"]
    slices = F.max(F.ceil(F.col("pairs") / pair_rows)).alias("slices")
    cells = F.broadcast(spots.groupBy(_cell().alias("cell")).agg(slices))  # at most CELLS rows
    # what lacks a part is in none of these cells, so nothing is NULL here; see _cell for why Spark is told so
    told = [F.coalesce("monitor_id", F.lit("")).alias("monitor_id"), F.coalesce("bucket", F.lit(0)).alias("bucket")]
    dealt = timed.withColumn("cell", _cell()).join(cells, "cell").select(
        *told, "car", "event_sec", F.pmod(F.xxhash64("car", "event_sec"), F.col("slices")).alias("slice")
    )
    copied = near.withColumn("cell", _cell()).join(cells, "cell").select(
        *near.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice")
    )
    met = _met(dealt.repartition(tasks, *keys), copied.repartition(tasks, *keys), keys)
    counted = met.groupBy(*RESULT, "bucket", "slice").agg(F.count("*").alias("n_passages"))
    return counted.repartition(tasks, *RESULT).groupBy(*RESULT).agg(F.sum("n_passages").alias("n_passages"))


def _reach(gap: int) -> Column:
    """The buckets a visit reaches into and, for each, the times that count: t <= until or t >= since."""
    b, none = F.col("bucket"), F.lit(None).cast("bigint")

    def row(bucket: Column, until: Column, since: Column) -> Column:
        return F.struct(bucket.alias("bucket"), until.alias("until"), since.alias("since"))

    return F.array(
        row(b - 1, none, F.col("first") - gap),
        row(b, none, b * gap),
        row(b + 1, F.col("last") + gap, none),
    )
