"""Positions and lists within a key, without ever putting a hot key into one task.

One car plate (think of "unreadable") or one checkpoint may hold a third of all rows. A window over the bare key would
sort that third in one task, and a collect_list would build one row of it. So keys are told apart by their counts,
which combine on the map side:

* Ordinary keys have at most ``hot_rows`` rows each and go the direct way: one shuffle by key.
* Hot keys are sliced along their own order, for example by second. Counts per (key, slice) and a running sum over them
  give the number of rows before each slice; rows are ranked inside their slice only, and both add up to the exact
  position. Their lists are built in parts of consecutive positions. The running sum is in two levels, so that it isn't
  one task for all seconds of a key either: over the days of the key, and over the seconds of each day.

Lists come in parts of ``part_rows`` items, for every key alike, so the rows of a result do not depend on ``hot_rows``,
which decides on the plan only. A key with at most ``part_rows`` items gives one row, part 0, with the whole list.

The hot keys are counted once, written to the shared folder, and broadcast if their number allows it. Each stands for
more than ``hot_rows`` rows, so they are few. Without hot keys adaptive execution drops the second way altogether.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.operators.sizing import broadcast_if_small
from roadlens.sinks import store

HOT_ROWS = 1_000_000
PART_ROWS = 1_000_000


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of keys with more than ``hot_rows`` rows. In a struct NULL keys match too.

    ``counted`` holds at least as many rows a key as ``df`` and is counted in its place: what ``df`` is derived from,
    where that takes no shuffle.
    """
    counts = (df if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = counts.where(F.col("_rows") > hot_rows).select(F.struct(*keys).alias("_key"))
    hot = broadcast_if_small(store.staged(hot, "hot"))
    keyed = df.withColumn("_key", F.struct(*keys))
    return tuple(keyed.join(hot, "_key", how).drop("_key") for how in ("left_anti", "left_semi"))


def slice_offsets(df: DataFrame, keys: Sequence[str], slice_: Column, span: Column | None = None) -> DataFrame:
    """Per (key, slice), as one struct column ``_group``: the rows of the key ``_before`` the slice.

    ``span`` joins slices in a row, such as the seconds of a day: sums run over the spans of a key and over the slices of
    a span, and no task has more rows than either. A slice has to be in one span, and spans in the order of the slices.
    """
    group = F.struct(*keys, slice_.alias("_slice")).alias("_group")
    if span is None:
        counts = df.groupBy(group).agg(F.count("*").alias("_rows"))
        return counts.select("_group", _running([F.col(f"_group.{k}") for k in keys], "_group._slice").alias("_before"))
    spans = F.struct(*keys, span.alias("_at")).alias("_span")
    counts = df.groupBy(spans, group).agg(F.count("*").alias("_rows"))
    totals = counts.groupBy("_span").agg(F.sum("_rows").alias("_rows"))
    earlier = totals.select("_span", _running([F.col(f"_span.{k}") for k in keys], "_span._at").alias("_earlier"))
    within = counts.select("_span", "_group", _running([F.col("_span")], "_group._slice").alias("_within"))
    return within.join(earlier, "_span").select("_group", (F.col("_earlier") + F.col("_within")).alias("_before"))


def _running(by: Sequence[Column], order: str) -> Column:
    """The rows before the current one."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_rows").over(before), F.lit(0))


def number_in_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_: Column, span: Column | None = None
) -> DataFrame:
    """Add ``pos``, the position (from 1) of each row in its key. ``slice_`` must never decrease along ``order``.

    The rows are shuffled and sorted once: the join with the offsets uses the partitions and the order of the ranking.
    """
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    ranked = df.withColumn("_group", F.struct(*keys, slice_.alias("_slice"))).withColumn("_rank", rank)
    return (
        ranked.join(slice_offsets(df, keys, slice_, span), "_group")
        .withColumn("pos", F.col("_before") + F.col("_rank"))
        .drop("_group", "_before", "_rank")
    )


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_: Column, hot_rows: int = HOT_ROWS,
    span: Column | None = None,
) -> DataFrame:
    """Add ``pos`` to the rows of all keys, sliced where the key is hot."""
    ordinary, hot = split_hot(df, keys, hot_rows)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    return ordinary.withColumn("pos", rank).unionByName(number_in_slices(hot, keys, order, slice_, span))


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_: Column,
    item: Column,
    sep: str,
    name: str,
    last: str | None = None,
    hot_rows: int = HOT_ROWS,
    part_rows: int = PART_ROWS,
    span: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join the items of each key in order, ``part_rows`` to a row.

    ``last`` is a column whose value at the last item of the part is kept. ``counted``: see ``split_hot``.
    """
    ordinary, hot = split_hot(df, keys, hot_rows, counted)
    part = F.floor((F.col("pos") - 1) / part_rows).cast("bigint").alias("part")

    def join_items(grouped, by: Sequence[str]) -> DataFrame:
        places = [F.col(c).alias(f"o{i}") for i, c in enumerate(by)]
        kept = [] if last is None else [F.col(last).alias("last")]
        rows = F.sort_array(F.collect_list(F.struct(*places, item.alias("item"), *kept)))
        return grouped.agg(rows.alias("_rows"))

    starts = F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / part_rows).cast("int"))
    cut = F.transform(starts, lambda i: F.slice("_rows", i * part_rows + 1, part_rows))
    whole = join_items(ordinary.groupBy(*keys), order).select(*keys, F.posexplode(cut).alias("part", "_rows"))
    whole = whole.withColumn("part", F.col("part").cast("bigint"))
    parts = join_items(number_in_slices(hot, keys, order, slice_, span).groupBy(*keys, part), ["pos"])
    text = F.array_join(F.transform("_rows", lambda r: r["item"]), sep).alias(name)
    kept = [] if last is None else [F.element_at("_rows", -1)["last"].alias(last)]
    return whole.select(*keys, "part", *kept, text).unionByName(parts.select(*keys, "part", *kept, text))
