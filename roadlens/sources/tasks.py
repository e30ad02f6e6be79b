"""Job parameters: the JSON document stored with a task, every value an array whose first element counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import first_element, params_map, safe_int

# Parameter names in the stored documents, and our column names for them.
PARAMS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "topNum": "top_num",
    "extractNum": "extract_num",
    "cars": "cars",
    "roadFlow": "road_flow",
    "areaName": "area_name",
}


@dataclass(frozen=True)
class JobParams:
    task_id: int
    start_date: str
    end_date: str
    top_num: int | None = None
    extract_num: int | None = None
    cars: tuple[str, ...] = ()
    road_flow: tuple[str, ...] = ()
    area_name: str | None = None


def task_params(tasks: DataFrame) -> DataFrame:
    """The parameters of every task as columns; NULL where a document lacks one. Each document is parsed once."""
    columns = {ours: first_element("doc", theirs) for theirs, ours in PARAMS.items()}
    for number in ("top_num", "extract_num"):
        columns[number] = safe_int(columns[number])
    parsed = tasks.select("task_id", params_map("task_param").alias("doc"))
    return parsed.select("task_id", *[c.alias(n) for n, c in columns.items()])


def load_params(tasks: DataFrame, task_id: int) -> JobParams:
    """The parameters of one task, for the driver. A missing task is an error."""
    row = task_params(tasks.where(F.col("task_id") == task_id)).first()
    if row is None:
        raise LookupError(f"no task {task_id}")
    if row.start_date is None or row.end_date is None:
        raise ValueError(f"task {task_id} has no date range")
    listed = lambda text: tuple(text.split(",")) if text else ()
    return JobParams(
        task_id, row.start_date, row.end_date, row.top_num, row.extract_num, listed(row.cars), listed(row.road_flow),
        row.area_name,
    )
