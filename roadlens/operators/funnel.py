"""How many cars follow a route of checkpoints step by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import unit_half_up
from roadlens.operators.ordering import HOT_ROWS
from roadlens.operators.tracks import TIE, in_car_order


def _matched(passages: DataFrame, flow: Sequence[str], tie: Sequence[str], hot_rows: int) -> DataFrame:
    """One row with the occurrences n1, n2, … of each prefix of the flow, summed over all tracks.

    A passage at position p of its track that equals step j of the flow supports an occurrence starting at p - j.
    So with positions known, only passages at checkpoints of the flow are needed, and an occurrence is a small group
    (car, start) of at most one row per step; no track is ever put together.
    """
    steps_of = {m: [j for j, step in enumerate(flow) if step == m] for m in flow}
    steps = F.create_map(*[F.lit(x) for pair in steps_of.items() for x in pair])
    support = (
        in_car_order(passages, tie, hot_rows)
        .where(F.col("monitor_id").isin(list(steps_of)))
        .select("car", "pos", F.explode(F.element_at(steps, F.col("monitor_id"))).alias("step"))
        .select("car", (F.col("pos") - F.col("step")).alias("start"), "step")
    )
    n = len(flow)
    # each step supports a start at most once, so steps 0..i-1 are all there when i rows lie below i
    starts = support.groupBy("car", "start").agg(*[F.count_if(F.col("step") < i).alias(f"k{i}") for i in range(1, n + 1)])
    return starts.agg(*[F.count_if(F.col(f"k{i}") == i).alias(f"n{i}") for i in range(1, n + 1)])


def _rows(counts: DataFrame, flow: Sequence[str]) -> DataFrame:
    """Turn the one row of counts into one row per prefix, each with the count of the prefix before it."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(",".join(flow[:i])).alias("flow"),
                F.col(f"n{i}").alias("cnt"),
                (F.col(f"n{i - 1}") if i > 1 else F.lit(None).cast("bigint")).alias("previous"),
            )
            for i in range(1, len(flow) + 1)
        ]
    )
    return counts.select(F.inline(entries))


def flow_prefix_counts(
    passages: DataFrame, flow: Sequence[str], tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Occurrences (overlapping ones too) of every prefix of the flow in the tracks; zero counts are rows as well."""
    return _rows(_matched(passages, flow, tie, hot_rows), flow).select("step", "flow", "cnt")


def flow_convert_rate(
    passages: DataFrame, flow: Sequence[str], tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Count of each prefix over that of the prefix before, two digits; none for the first or after a zero count."""
    rate = F.col("cnt").cast("double") / F.col("previous").cast("double")
    return (
        _rows(_matched(passages, flow, tie, hot_rows), flow)
        .where(F.col("previous") > 0)
        .select("step", "flow", unit_half_up(rate).alias("rate"))
    )
