"""One query per operator over the tables of a test-data folder, each over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import columns as c
from roadlens.functions import registry
from roadlens.operators import areas, clicks, filters, funnel, monitors, sampling, tracks
from roadlens.plans import inputs
from roadlens.plans.inputs import TIE
from roadlens.schema import CLICK_FIELDS, PASSAGE_FIELDS
from roadlens.sinks import car_lists, store
from roadlens.sources import streams, tasks
from roadlens.streaming import clicks as click_stream
from roadlens.streaming import common, road

Query = Callable[[SparkSession, str], DataFrame]

FLOW = ("0000", "0001", "0002")
EXTRACT_NUM = 600
HOUR = "1 hour"
ROAD_WINDOW = ("1 hour", "10 minutes")
# Options of the replayed streams, such as maxFilesPerTrigger.
REPLAY: dict[str, str] = {}
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _time_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# --- sources and scalar helpers


@query
def task_params(spark, d):
    return tasks.task_params(inputs.tasks(spark, d))


@query
def parse_click_log(spark, d):
    return streams.parse_clicks(inputs.click_lines(spark, d), keep=["event_id"])


@query
def parse_road_log(spark, d):
    parsed = streams.parse_passages(inputs.passage_lines(spark, d), keep=["event_id"])
    return parsed.select("event_id", *PASSAGE_FIELDS, _time_text("event_ts"))


@query
def parse_active_log(spark, d):
    return streams.parse_active_users(inputs.active_lines(spark, d), keep=["event_id"])


@query
def passage_labels(spark, d):
    return inputs.passages(spark, d).select(
        "event_id",
        c.date_hour("action_time").alias("date_hour"),
        c.range_label("action_time").alias("range_time"),
        c.zero_pad("road_id", 2).alias("road_id"),
        c.safe_int("speed").alias("speed_kmh"),
        c.safe_int("car").alias("not_a_number"),
        c.speed_band(c.safe_int("speed")).alias("band"),
        c.lenient_seconds("action_time").alias("event_sec"),
        _time_text_of(c.lenient_ts("action_time")).alias("event_time"),
        c.field_from_concat(F.concat_ws("|", F.concat(F.lit("m="), "monitor_id"), F.concat(F.lit("car="), "car")), "car")
        .alias("car"),
    )


def _time_text_of(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _dirty(spark, d):
    """Passages whose times are damaged by event_id: no space, cut short, or out of range."""
    t, i = F.col("action_time"), F.col("event_id") % 8
    damaged = (
        F.when(i == 1, F.replace(t, F.lit(" "), F.lit("T")))
        .when(i == 2, F.substring(t, 1, 16))
        .when(i == 3, F.substring(t, 1, 13))
        .when(i == 4, F.substring(t, 1, 10))
        .when(i == 5, F.concat(F.substring(t, 1, 11), F.lit("99:99:99")))
        .otherwise(t)
    )
    return inputs.passages(spark, d).withColumn("action_time", damaged)


@query
def dirty_passage_labels(spark, d):
    return _dirty(spark, d).select(
        "event_id",
        c.date_hour("action_time").alias("date_hour"),
        c.range_label("action_time").alias("range_time"),
        c.lenient_seconds("action_time").alias("event_sec"),
        _time_text_of(c.lenient_ts("action_time")).alias("event_time"),
    )


@query
def sample_quota_dirty(spark, d):
    return sampling.sample_quota(_dirty(spark, d), EXTRACT_NUM)


@query
def sql_functions(spark, d):
    registry.register(spark)
    return inputs.passages(spark, d).select(
        "event_id",
        F.expr("concat_String_string(monitor_id, camera_id, '=')").alias("joined"),
        F.expr("remove_random_prefix(random_prefix(car, 10))").alias("salted_and_back"),
        F.expr("safe_int(speed)").alias("speed_kmh"),
        F.expr("safe_int(concat(' ', speed))").alias("not_a_number"),
        F.expr("zero_pad(road_id, 2)").alias("road"),
        F.expr("date_hour(action_time)").alias("hour"),
        F.expr("flow_level(safe_int(speed))").alias("level"),
        F.expr("speed_band(safe_int(speed))").alias("band"),
        F.element_at(c.map_from_concat(F.expr("concat('a=', car, '|b=', speed, '|a=', road_id)")), "a").alias("last_a"),
    )


# --- filters and joins


@query
def filter_date_range(spark, d):
    return filters.by_date(inputs.passages(spark, d), "2024-01-05", "2024-01-24")


@query
def filter_date_cars(spark, d):
    wanted = ["C00001", "C00002", "C00003"]
    return filters.by_date_and_cars(inputs.passages(spark, d), "2024-01-05", "2024-01-24", wanted)


@query
def filter_time_monitors(spark, d):
    wanted = ["0001", "0003", "0005"]
    return filters.by_time_and_monitors(
        inputs.passages(spark, d), "2024-01-05 06:00:00", "2024-01-24 18:00:00", wanted
    )


@query
def filter_area_name(spark, d):
    named = areas.enrich(inputs.passages(spark, d), inputs.areas(spark, d))
    per_monitor = named.groupBy("monitor_id", "area_name").agg(F.count("*").alias("car_count"))
    return areas.with_area_name(per_monitor, "NATION_3")


@query
def filter_watched_cars(spark, d):
    return filters.by_key_table(inputs.passages(spark, d), inputs.watchlist(spark, d), "car")


@query
def semi_top_monitors(spark, d):
    p = inputs.passages(spark, d)
    fastest = monitors.fastest_monitors(monitors.speed_bands(p), 5)
    return filters.by_key_table(p, fastest, "monitor_id")


@query
def enrich_area(spark, d):
    return areas.enrich(inputs.passages(spark, d), inputs.areas(spark, d))


@query
def enrich_area_left(spark, d):
    return areas.enrich(inputs.passages(spark, d), inputs.areas(spark, d), "left")


# --- checkpoints


@query
def monitor_observed(spark, d):
    return monitors.observed(inputs.passages(spark, d))


@query
def monitor_roster(spark, d):
    return monitors.roster_by_monitor(inputs.roster(spark, d))


@query
def roster_left_join(spark, d):
    return monitors.roster_with_observed(inputs.roster(spark, d), inputs.passages(spark, d))


@query
def monitor_state(spark, d):
    return monitors.monitor_state(monitors.monitor_health(inputs.roster(spark, d), inputs.passages(spark, d)))


@query
def monitor_state_by_set(spark, d):
    health = monitors.monitor_health(inputs.roster(spark, d), inputs.passages(spark, d), rule="set")
    return monitors.monitor_state(health)


@query
def monitor_state_detail(spark, d):
    return monitors.abnormal_monitors(monitors.monitor_health(inputs.roster(spark, d), inputs.passages(spark, d)))


@query
def topn_monitors(spark, d):
    return monitors.top_monitors(inputs.roster(spark, d), inputs.passages(spark, d), 3)


@query
def topn_monitor_details(spark, d):
    p = inputs.passages(spark, d)
    return monitors.passages_of(p, monitors.top_monitors(inputs.roster(spark, d), p, 3))


@query
def speed_bands(spark, d):
    return monitors.speed_bands(inputs.passages(spark, d))


@query
def speed_top_monitors(spark, d):
    return monitors.fastest_monitors(monitors.speed_bands(inputs.passages(spark, d)))


@query
def speed_top10_details(spark, d):
    p = inputs.passages(spark, d)
    return monitors.fastest_passages(p, monitors.fastest_monitors(monitors.speed_bands(p)), tie=TIE)


# --- areas and roads


@query
def area_road_flow(spark, d):
    return areas.area_road_flow(inputs.passages(spark, d), inputs.areas(spark, d))


@query
def area_road_flow_salted(spark, d):
    return areas.area_road_flow_salted(inputs.passages(spark, d), inputs.areas(spark, d), salt_on=TIE)


@query
def area_top3_roads(spark, d):
    return areas.top_roads(areas.area_road_flow(inputs.passages(spark, d), inputs.areas(spark, d)))


# --- tracks, routes, samples


@query
def car_track(spark, d):
    return tracks.car_track(inputs.passages(spark, d), TIE)


@query
def car_track_times(spark, d):
    return tracks.car_track_times(inputs.passages(spark, d), TIE)


@query
def monitor_5min_cars(spark, d):
    return tracks.monitor_5min_cars(inputs.passages(spark, d), tie=TIE)


@query
def monitor_5min_cars_all(spark, d):
    return tracks.monitor_5min_cars(inputs.passages(spark, d), last_only=False, tie=TIE)


@query
def monitor_5min_cars_incremental(spark, d):
    """The same lists, kept by a log that takes the passages in two runs."""
    p, path = inputs.passages(spark, d), f"{store.shared_folder(spark)}/roadlens-{uuid.uuid4().hex}/lists"
    first = F.col("date") <= "2024-01-16"
    for days in (p.where(first), p.where(~first)):
        car_lists.add_passages(path, days, tie=TIE)
    return car_lists.read_lists(spark, path)


@query
def companion_pairs(spark, d):
    return tracks.companions(inputs.passages(spark, d), inputs.watchlist(spark, d))


@query
def flow_prefix_counts(spark, d):
    return funnel.flow_prefix_counts(inputs.passages(spark, d), FLOW, TIE)


@query
def flow_convert_rate(spark, d):
    return funnel.flow_convert_rate(inputs.passages(spark, d), FLOW, TIE)


@query
def hourly_distinct_cars(spark, d):
    return sampling.hourly_distinct_cars(inputs.passages(spark, d))


@query
def hourly_share(spark, d):
    return sampling.hourly_share(inputs.passages(spark, d))


@query
def sample_quota(spark, d):
    return sampling.sample_quota(inputs.passages(spark, d), EXTRACT_NUM)


@query
def sample_cars(spark, d):
    return sampling.sample_cars(inputs.passages(spark, d), EXTRACT_NUM)


@query
def sampled_car_details(spark, d):
    return sampling.sampled_car_details(inputs.passages(spark, d), EXTRACT_NUM)


@query
def sampled_car_tracks(spark, d):
    p = inputs.passages(spark, d)
    sample = store.staged(sampling.sample_cars(p, EXTRACT_NUM), "sample")
    return tracks.car_track(sampling.passages_of_sample(p, sample, EXTRACT_NUM), TIE)


# --- clicks


def _counts(spark, d):
    return clicks.click_counts(inputs.clicks(spark, d), HOUR)


def _totals(spark, d):
    return clicks.ad_totals(inputs.clicks(spark, d), inputs.blacklist(spark, d), HOUR)


@query
def ad_batch_counts(spark, d):
    return _counts(spark, d).select(_time_text("window_start"), *CLICK_FIELDS, "n")


@query
def ad_batch_valid(spark, d):
    return clicks.valid_clicks(_counts(spark, d)).select(_time_text("window_start"), *CLICK_FIELDS, "n")


@query
def ad_totals(spark, d):
    return _totals(spark, d)


@query
def ad_blacklist(spark, d):
    return clicks.new_blacklist(_totals(spark, d), 2, inputs.blacklist(spark, d))


@query
def active_users(spark, d):
    records = streams.parse_active_users(inputs.active_lines(spark, d))
    kept = clicks.without_blacklisted(records, inputs.blacklist(spark, d))
    return clicks.active_users(kept, HOUR).select(_time_text("window_start"), "active_users")


def _exact_users(spark, d, window):
    records = clicks.without_blacklisted(inputs.clicks(spark, d), inputs.blacklist(spark, d))
    return clicks.active_users(records, window)


def _within(sketched, exact):
    """Exact counts, and whether the sketches are within two in a hundred of them."""
    both = exact.join(sketched.withColumnRenamed("active_users", "estimate"), "window_start")
    near = F.abs(F.col("estimate") - F.col("active_users")) * 50 <= F.col("active_users")
    return both.select(_time_text("window_start"), "active_users", near.alias("within_2_percent"))


@query
def active_users_sketched(spark, d):
    """Users per day from sketches per hour."""
    records = clicks.without_blacklisted(inputs.clicks(spark, d), inputs.blacklist(spark, d))
    days = clicks.count_sketched_users(clicks.user_sketches(records, HOUR), "1 day")
    return _within(days, _exact_users(spark, d, "1 day"))


# --- streams: each replays the whole events table, waits for the end, and reads what was written


class _Run:
    """Folders of one run below the shared folder, and the events as a stream that closes its last windows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.base = f"{store.shared_folder(spark)}/roadlens-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def events(self, closing: bool = True) -> DataFrame:
        path = f"{self.folder}/events.parquet"
        return common.replay(self.spark, path, self.path("closing") if closing else None, **REPLAY)

    def close(self, start) -> None:
        common.run_closed(start, inputs.table(self.spark, self.folder, "events"), "ts", self.path("closing"))

    def blacklist(self) -> str:
        path = self.path("blacklist")
        click_stream.create_blacklist(self.spark, path, inputs.blacklist(self.spark, self.folder))
        return path

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def _valid_clicks(run: _Run) -> None:
    events = inputs.clicks_of(run.events())
    run.close(
        lambda: click_stream.start_valid_clicks(events, run.path("valid"), run.path("cp-valid"), HOUR, delay=HOUR)
    )


@query
def stream_road_state(spark, d):
    run = _Run(spark, d)
    rows = inputs.passages_of(run.events())
    run.close(lambda: road.start_road_state(rows, run.path("out"), run.path("cp"), *ROAD_WINDOW, delay=HOUR))
    return run.read("out").select(_time_text("window_start"), "monitor_id", "speed_sum", "car_count", "mean_speed")


@query
def stream_road_state_now(spark, d):
    run = _Run(spark, d)
    rows = inputs.passages_of(run.events(closing=False))
    road.start_road_state_now(rows, run.path("out"), run.path("cp"), ROAD_WINDOW[1], delay=HOUR).awaitTermination()
    windows = road.read_road_state_now(spark, run.path("out"), *ROAD_WINDOW)
    return windows.select(_time_text("window_start"), "monitor_id", "speed_sum", "car_count", "mean_speed")


@query
def stream_watchlist(spark, d):
    run = _Run(spark, d)
    inputs.watchlist(spark, d).select("car").write.text(run.path("wanted"))
    rows = inputs.passages_of(run.events(closing=False)).select("event_id", *PASSAGE_FIELDS)
    road.start_watchlist(rows, run.path("wanted"), run.path("out"), run.path("cp")).awaitTermination()
    return store.read_all(spark, run.path("out"), rows.schema).drop("batch_id")


@query
def stream_ad_valid(spark, d):
    run = _Run(spark, d)
    _valid_clicks(run)
    return run.read("valid").select(_time_text("window_start"), *CLICK_FIELDS, "n")


@query
def stream_blacklist_filter(spark, d):
    run = _Run(spark, d)
    rows = inputs.clicks_of(run.events(closing=False)).select("event_id", *CLICK_FIELDS)
    click_stream.start_filter(rows, run.blacklist(), run.path("out"), run.path("cp")).awaitTermination()
    return store.read_all(spark, run.path("out"), rows.schema).drop("batch_id")


def _stream_totals(run: _Run) -> str:
    _valid_clicks(run)
    log = run.blacklist()
    valid = click_stream.read_valid_clicks(run.spark, run.path("valid"))
    click_stream.start_totals(valid, log, run.path("cp-totals"), 2).awaitTermination()
    return log


@query
def stream_ad_totals(spark, d):
    return click_stream.read_totals(spark, _stream_totals(_Run(spark, d)))


@query
def stream_ad_blacklist(spark, d):
    """The users the stream itself listed, on top of those known from the start."""
    log = _stream_totals(_Run(spark, d))
    return clicks.without_blacklisted(click_stream.blacklist(spark, log), inputs.blacklist(spark, d))


@query
def stream_active_users(spark, d):
    run = _Run(spark, d)
    records, listed = inputs.clicks_of(run.events()), run.blacklist()
    run.close(
        lambda: click_stream.start_active_users(
            records, run.path("out"), run.path("cp"), HOUR, HOUR, blacklist_path=listed
        )
    )
    return clicks.count_users(run.read("out")).select(_time_text("window_start"), "active_users")


@query
def stream_user_sketches(spark, d):
    run = _Run(spark, d)
    records, listed = inputs.clicks_of(run.events()), inputs.blacklist(spark, d)
    run.close(
        lambda: click_stream.start_user_sketches(records, run.path("out"), run.path("cp"), HOUR, HOUR, blacklist=listed)
    )
    return _within(clicks.count_sketched_users(run.read("out")), _exact_users(spark, d, HOUR))
