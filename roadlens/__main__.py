"""Run a job. Batch: python -m roadlens JOB --task-id N --tasks … --passages … --out …
Store the fact by day: python -m roadlens store-passages --passages … --out …
Stream: python -m roadlens JOB --lines FOLDER (or --servers … --topics …) --out … --checkpoint … [--every "10 seconds"]"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from roadlens.plans import jobs
from roadlens.session import configure
from roadlens.sinks.tables import jdbc_saver, path_saver, table_saver, write_partitioned
from roadlens.sources.streams import read_kafka
from roadlens.sources.tables import read_jdbc, read_passages, read_roster, read_table
from roadlens.sources.tasks import load_params
from roadlens.streaming import jobs as stream_jobs
from roadlens.streaming.common import ONCE

JOBS = ("monitor-flow", "random-extract", "with-the-car", "area-top3", "convert-rate")
STREAM_JOBS = ("stream-roads", "stream-clicks", "stream-users")


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def stream(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="roadlens", description=__doc__)
    parser.add_argument("job", choices=STREAM_JOBS)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--lines", help="folder that text files are put into")
    source.add_argument("--servers", help="Kafka servers")
    parser.add_argument("--topics", default="", help="Kafka topics, parted by commas")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the source")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--every", help="interval of the batches; without it one pass over what is there")
    parser.add_argument("--watchlist", help="stream-roads: text file of wanted plates")
    parser.add_argument("--blacklist", help="stream-clicks, stream-users: store of the listed users")
    parser.add_argument("--threshold", type=int, default=50, help="stream-clicks: clicks above which a user is listed")
    parser.add_argument("--print", action="store_true", help="stream-roads: print the windows as well")
    args = parser.parse_args(argv)
    if args.job != "stream-roads" and not args.blacklist:
        parser.error(f"{args.job} needs --blacklist")

    spark = configure(SparkSession.builder.appName(f"roadlens {args.job}").getOrCreate(), streams=True)
    more = _options(args.option)
    if args.lines:
        lines = stream_jobs.read_text_lines(spark, args.lines, **more)
    else:
        lines = read_kafka(spark, args.servers, args.topics.split(","), **more)
    trigger = {"processingTime": args.every} if args.every else ONCE
    if args.job == "stream-roads":
        started = stream_jobs.roads(lines, args.out, args.checkpoint, args.watchlist, trigger, args.print)
    elif args.job == "stream-clicks":
        started = stream_jobs.ad_clicks(lines, args.out, args.checkpoint, args.blacklist, args.threshold, trigger)
    else:
        started = stream_jobs.users(lines, args.out, args.checkpoint, args.blacklist, trigger)
    if args.every:
        spark.streams.awaitAnyTermination()
    for query in started:
        query.awaitTermination()


def store_passages(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="roadlens store-passages")
    parser.add_argument("--passages", required=True, help="table or path")
    parser.add_argument("--format", default="parquet", help="format of the files of a path")
    parser.add_argument("--out", required=True, help="folder of the fact, partitioned by day")
    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.appName("roadlens store-passages").getOrCreate())
    write_partitioned(read_passages(spark, args.passages, args.format), args.out)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    if argv and argv[0] in STREAM_JOBS:
        return stream(argv)
    if argv and argv[0] == "store-passages":
        return store_passages(argv[1:])
    parser = argparse.ArgumentParser(prog="roadlens", description=__doc__)
    parser.add_argument("job", choices=JOBS, help=f"or a stream job: {', '.join(STREAM_JOBS)}")
    parser.add_argument("--task-id", type=int, required=True)
    parser.add_argument("--tasks", required=True, help="table or Parquet path of the tasks")
    parser.add_argument("--passages", default="monitor_flow_action")
    parser.add_argument("--roster", default="monitor_camera_info")
    parser.add_argument("--areas", default="area_info")
    parser.add_argument(
        "--source-jdbc-url", help="database of the tasks and areas; the password comes from ROADLENS_SOURCE_PASSWORD"
    )
    parser.add_argument("--source-jdbc-user")
    parser.add_argument("--lists", help="with-the-car: folder of the five-minute lists that runs of a task add to")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder for the results")
    target.add_argument("--database", help="database of managed tables for the results")
    target.add_argument("--jdbc-url", help="database for the results; the password comes from ROADLENS_JDBC_PASSWORD")
    parser.add_argument("--jdbc-user")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"roadlens {args.job}").getOrCreate())

    def small(name: str) -> DataFrame:
        if not args.source_jdbc_url:
            return read_table(spark, name)
        return read_jdbc(spark, args.source_jdbc_url, name, args.source_jdbc_user, os.environ.get("ROADLENS_SOURCE_PASSWORD"))

    params = load_params(small(args.tasks), args.task_id)
    passages = read_passages(spark, args.passages)
    if args.job == "monitor-flow":
        results = jobs.monitor_flow(passages, read_roster(spark, args.roster), params)
    elif args.job == "random-extract":
        results = jobs.random_extract(passages, params)
    elif args.job == "with-the-car":
        results = jobs.with_the_car(passages, params, lists=args.lists)
    elif args.job == "area-top3":
        results = jobs.area_top3(passages, small(args.areas), params)
    else:
        results = jobs.convert_rate(passages, params)
    if args.jdbc_url:
        save = jdbc_saver(args.jdbc_url, args.jdbc_user, os.environ.get("ROADLENS_JDBC_PASSWORD"))
    elif args.database:
        save = table_saver(args.database)
    else:
        save = path_saver(args.out)
    jobs.run(results, args.task_id, save)


if __name__ == "__main__":
    main()
