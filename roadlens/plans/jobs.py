"""The batch jobs: from a task's parameters to its result tables.

Each job is a function from the inputs to named results; ``run`` saves them. Nothing is cached: every result reads only
its own columns of the days in the date range, which is cheaper than holding the fact in memory, and what is costly to
make and small, such as counts or a sample, is written to the shared folder, where it outlives a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators import areas as area_ops
from roadlens.operators import filters, funnel, monitors, sampling, tracks
from roadlens.operators.sizing import broadcast_if_small
from roadlens.sinks import car_lists, store
from roadlens.sinks.tables import Save
from roadlens.sources.tasks import JobParams

Results = dict[str, DataFrame]

# Column order of the stored passage details.
DETAIL_FIELDS = ("date", "monitor_id", "camera_id", "car", "action_time", "speed", "road_id")


def _days(passages: DataFrame, params: JobParams) -> DataFrame:
    return filters.by_date(passages, params.start_date, params.end_date)


def _needed(value, name: str, params: JobParams):
    if value is None or value == ():
        raise ValueError(f"task {params.task_id} lacks {name}")
    return value


def monitor_flow(passages: DataFrame, roster: DataFrame, params: JobParams) -> Results:
    """Camera health, busiest checkpoints with their passages, and the fastest passages at the fastest checkpoints.

    One pass over the fact counts for all four; only the passages that two of them list are read in a second and third.
    """
    days, n = _days(passages, params), _needed(params.top_num, "topNum", params)
    counts = store.staged(monitors.counted(days), "counts")
    top = monitors.top_monitors(roster, counts, n)
    fastest = monitors.fastest_monitors(monitors.speed_bands(counts))
    return {
        "topn_monitor_car_count": top,
        "topn_monitor_detail_info": monitors.passages_of(days, top).select(*DETAIL_FIELDS),
        "monitor_state": monitors.monitor_state(monitors.monitor_health(roster, counts)),
        "top10_speed_detail": monitors.fastest_passages(days, fastest, counts=counts).select(*DETAIL_FIELDS),
    }


def random_extract(passages: DataFrame, params: JobParams, seed: int = 42, tie: Sequence[str] = tracks.TIE) -> Results:
    """A sample of cars spread over the hours, their passages, and their tracks.

    Drawing shuffles each car of each hour, so the sample is written once and read by all three results.
    """
    days, n = _days(passages, params), _needed(params.extract_num, "extractNum", params)
    sample = store.staged(sampling.sample_cars(days, n, seed), "sample")
    details = sampling.passages_of_sample(days, sample, n)
    return {
        "random_extract_car": sample.select("car", "date", "date_hour"),
        "random_extract_car_detail_info": details.select(*DETAIL_FIELDS),
        "car_track": tracks.car_track(details, tie).select("date", "car", "track", "part"),
    }


def with_the_car(
    passages: DataFrame, params: JobParams, run_date: str | None = None, tie: Sequence[str] = tracks.TIE,
    lists: str | None = None,
) -> Results:
    """All tracks with times, the cars of each checkpoint in five minutes, and companions of the task's cars.

    With ``lists``, a log per task, this run's passages are added to what earlier runs of the task stored there.
    """
    days = _days(passages, params)
    today = F.date_format(F.current_date(), "yyyy-MM-dd") if run_date is None else F.lit(run_date)
    if lists is None:
        ranges = tracks.monitor_5min_cars(days, tie=tie)
    else:
        stored = f"{lists}/task_id={params.task_id}"
        car_lists.add_passages(stored, days, tie=tie)
        ranges = car_lists.read_lists(days.sparkSession, stored)
    results = {
        "car_track": tracks.car_track_times(days, tie).select(today.alias("date"), "car", "track", "part"),
        "monitor_range_time_car": ranges.select("monitor_id", "range_time", "cars", "part"),
    }
    if params.cars:
        wanted = days.sparkSession.createDataFrame([(c,) for c in params.cars], "car string")
        results["companion_cars"] = tracks.companions(days, broadcast_if_small(wanted))
    return results


def area_top3(passages: DataFrame, areas: DataFrame, params: JobParams, salts: int = 0) -> Results:
    """Busiest roads of each area. The areas may come from a database, whose size is checked before broadcasting."""
    days, areas = _days(passages, params), broadcast_if_small(areas)
    if salts:
        flow = area_ops.area_road_flow_salted(days, areas, salts)
    else:
        flow = area_ops.area_road_flow(days, areas)
    return {"areaTop3Road": area_ops.top_roads(flow)}


def convert_rate(passages: DataFrame, params: JobParams, tie: Sequence[str] = tracks.TIE) -> Results:
    """Step conversion along the task's route."""
    flow = _needed(params.road_flow, "roadFlow", params)
    return {"monitor_convert_rate": funnel.flow_convert_rate(_days(passages, params), flow, tie)}


def run(results: Results, task_id: int, save: Save) -> None:
    for name, result in results.items():
        save(name, task_id, result)
