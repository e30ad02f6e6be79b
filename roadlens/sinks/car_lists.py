"""The cars of each checkpoint in five minutes, kept up to date by runs that bring new passages.

A log holds the visits and the lists made of them. A run finds the (checkpoint, range) groups it changes, forms only
their lists anew, from the stored and the new visits, and adds both in one commit; what it doesn't change stays as it
lies. Where a list names a car's last visit only, a later visit takes the car out of an earlier list, which may so end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.operators import tracks
from roadlens.sinks.log import Log, Table

LISTS = T.StructType(
    [
        T.StructField("monitor_id", T.StringType()), T.StructField("range_time", T.StringType()),
        T.StructField("part", T.LongType()), T.StructField("cars", T.StringType()),
    ]
)
_GROUP, _VISIT = ("monitor_id", "range_time"), ("monitor_id", "car")


def _log(spark: SparkSession, path: str, visits: T.StructType | None = None, last_only: bool = True) -> Log:
    tables = {"lists": Table(LISTS, _GROUP, sets=True)}
    return Log(spark, path, tables | ({} if visits is None else {"visits": Table(visits, _VISIT if last_only else ())}))


def _key(*columns: str | Column) -> Column:
    """In a struct NULL keys match too."""
    return F.struct(*columns).alias("_key")


def _later(visits: DataFrame, known: DataFrame, order: Sequence[str]) -> DataFrame:
    """The visits that come after the stored one of their car and checkpoint, with the range that one is listed in."""
    mine = known.withColumn("_key", _key(*_VISIT)).join(visits.select(_key(*_VISIT)).distinct(), "_key", "left_semi")
    both = visits.withColumn("stored", F.lit(False)).unionByName(mine.select(*visits.columns, F.lit(True).alias("stored")))
    rest = [c for c in visits.columns if c not in (*_VISIT, *order)]
    newest = both.groupBy(*_VISIT).agg(
        F.max(F.struct(*[c for c in order if c not in _VISIT], "stored", *rest)).alias("v"),
        F.max(F.when(F.col("stored"), F.col("range_time"))).alias("left_range"),
    )
    values = [F.col(c) if c in _VISIT else F.col(f"v.{c}").alias(c) for c in visits.columns]
    return newest.where(~F.col("v.stored")).select(*values, "left_range")


def add_passages(
    path: str, passages: DataFrame, last_only: bool = True, tie: Sequence[str] = tracks.TIE, run: int | None = None, **sizes: int
) -> None:
    """Add the visits of ``passages`` to the log and form the lists they change.

    Runs over parts of the passages, in any order, end with the lists of all. With ``last_only`` a run over passages that
    are in changes nothing; without it, every run adds its visits, unless ``run`` numbers it and that number is in.
    """
    visits = tracks.range_visits(passages, last_only, tie)
    schema = T.StructType([*visits.schema, T.StructField("left_range", T.StringType())])
    log = _log(passages.sparkSession, path, schema, last_only)
    if run is not None and log.done(run):
        return
    if last_only:
        changed = _later(visits, log.read("visits"), ["event_sec", *tie])
    else:
        changed = visits.withColumn("left_range", F.lit(None).cast("string"))
    folder = log.write("visits", changed)
    if folder is None:
        log.commit({}, run)
        return
    changed = log.at("visits", folder)
    left = changed.where(F.col("left_range").isNotNull()).select(_key("monitor_id", F.col("left_range").alias("range_time")))
    touched = changed.select(_key(*_GROUP)).union(left).distinct()
    now = log.read("visits", more=folder).withColumn("_key", _key(*_GROUP)).join(touched, "_key", "left_semi")
    lists = tracks.cars_per_range(now.drop("_key", "left_range"), tie, **sizes)
    ended = touched.join(now.select("_key").distinct(), "_key", "left_anti")
    ended = ended.select("_key.*", F.lit(0).cast("long").alias("part"), F.lit(None).cast("string").alias("cars"))
    log.commit({"visits": folder, "lists": log.write("lists", lists.unionByName(ended))}, run)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """monitor_id, range_time, part and cars of all groups."""
    return _log(spark, path).read("lists").where(F.col("cars").isNotNull())
