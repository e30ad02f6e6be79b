"""Areas and roads: enrichment, flow per road, busiest roads of each area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.columns import FLOW_THRESHOLDS, flow_level


def enrich(passages: DataFrame, areas: DataFrame, how: str = "inner") -> DataFrame:
    """Add area_name. ``inner`` drops passages of unknown areas, ``left`` keeps them with NULL."""
    return passages.join(areas.select("area_id", "area_name"), "area_id", how)


def with_area_name(named: DataFrame, area_name: str) -> DataFrame:
    return named.where(F.col("area_name") == area_name)


def _name_and_list(counted: DataFrame, areas: DataFrame) -> DataFrame:
    """From counts per (area, road, checkpoint) to one row per (area name, road).

    The join with the areas comes after the counting, so it sees one row per checkpoint of a road and not one per
    passage. The list holds each checkpoint of a road once; its length is bounded by the checkpoints, not the passages.
    """
    per_monitor = (
        enrich(counted, areas).groupBy("area_name", "road_id", "monitor_id").agg(F.sum("n").alias("n"))
    )
    frequency = "listagg(concat(monitor_id, '=', n), '|') WITHIN GROUP (ORDER BY monitor_id)"
    return per_monitor.groupBy("area_name", "road_id").agg(
        F.sum("n").alias("car_count"), F.expr(frequency).alias("monitor_infos")
    )


def area_road_flow(passages: DataFrame, areas: DataFrame) -> DataFrame:
    """Passages per area and road, with the frequency map 'monitor=n|monitor=n' of its checkpoints."""
    counted = passages.groupBy("area_id", "road_id", "monitor_id").agg(F.count("*").alias("n"))
    return _name_and_list(counted, areas)


def area_road_flow_salted(
    passages: DataFrame, areas: DataFrame, salts: int = 10, salt_on: Sequence[str] = ("car", "action_time")
) -> DataFrame:
    """The same result in two counting phases: salted partial counts first, then their sums.

    Counts already combine on the map side; the salt also splits the merge of the partial counts of one hot road.
    It is a hash of the row itself, so a task that is run again gives the same rows.
    """
    salted = (
        passages.withColumn("salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
        .groupBy("salt", "area_id", "road_id", "monitor_id")
        .agg(F.count("*").alias("n"))
    )
    counted = salted.groupBy("area_id", "road_id", "monitor_id").agg(F.sum("n").alias("n"))
    return _name_and_list(counted, areas)


def top_roads(flow: DataFrame, top_n: int = 3, thresholds: Sequence[int] = FLOW_THRESHOLDS) -> DataFrame:
    """Busiest roads of each area with their flow level; equal counts go by road_id."""
    rank = F.row_number().over(Window.partitionBy("area_name").orderBy(F.desc("car_count"), "road_id"))
    return (
        flow.withColumn("rn", rank)
        .where(F.col("rn") <= top_n)
        .withColumn("flow_level", flow_level("car_count", thresholds))
        .select("area_name", "road_id", "car_count", "monitor_infos", "flow_level")
    )
