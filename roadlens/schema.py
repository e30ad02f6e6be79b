"""Schemas of the inputs. Every column of the fact and its dimensions is nullable text."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names and order of the input tables and stream records.
PASSAGE_FIELDS = ("date", "monitor_id", "camera_id", "car", "action_time", "speed", "road_id", "area_id")
ROSTER_FIELDS = ("monitor_id", "camera_id")
AREA_FIELDS = ("area_id", "area_name")
CLICK_FIELDS = ("click_date", "ip", "user_id", "ad_id", "province", "city")

PASSAGES = _text(*PASSAGE_FIELDS)
ROSTER = _text(*ROSTER_FIELDS)
AREAS = _text(*AREA_FIELDS)
CLICKS = _text(*CLICK_FIELDS)
TASKS = T.StructType(
    [T.StructField("task_id", T.LongType())]
    + [
        T.StructField(n, T.StringType())
        for n in ("task_name", "create_time", "start_time", "finish_time", "task_type", "task_status", "task_param")
    ]
)
BLACKLIST = _text("user_id")
