"""Streams fed file by file: restarts, late rows, live lists, and agreement with the batch operators."""

import os
import time

import pytest
from pyspark.sql import functions as F

from roadlens.operators import clicks as ops
from roadlens.plans import inputs
from roadlens.schema import CLICK_FIELDS, PASSAGE_FIELDS
from roadlens.session import STREAM_SETTINGS, configure
from roadlens.sinks import store
from roadlens.sources.streams import parse_active_users, parse_clicks, parse_passages
from roadlens.streaming import clicks, common, road

CLICK_SCHEMA = "event_ts timestamp, " + ", ".join(f"{f} string" for f in CLICK_FIELDS)


class Feed:
    """A folder of files that a stream reads one per batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0

    def add(self, rows):
        df = rows if hasattr(rows, "columns") else self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def click(spark, time, user, ad="a"):
    ts = spark.sql(f"SELECT timestamp'2024-01-05 {time}'").first()[0]
    return (ts, "2024-01-05", f"ip{user}", user, ad, "P", "C")


def totals(df):
    return {(r.user_id, r.ad_id): r.clicked_count for r in df.collect()}


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in", CLICK_SCHEMA)


def test_valid_clicks_over_files_and_restart(spark, tmp_path, feed):
    """A repeat in a later file of the same interval counts as a repeat; a restart neither loses nor doubles."""
    out, cp = str(tmp_path / "valid"), str(tmp_path / "cp")
    run = lambda: clicks.start_valid_clicks(feed.stream(), out, cp, delay="0 seconds").awaitTermination()
    feed.add([click(spark, "10:00:01", "u"), click(spark, "10:00:02", "v")])
    feed.add([click(spark, "10:00:05", "u")])
    run()
    assert spark.read.schema(clicks.COUNTS).parquet(out).count() == 0
    feed.add([click(spark, "10:00:31", "w")])
    run()
    feed.add([click(spark, "10:01:31", "x")])
    run()
    run()
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == ["v", "w"]


def test_late_clicks_are_left_out(spark, tmp_path, feed):
    out = str(tmp_path / "valid")
    feed.add([click(spark, "10:05:00", "u")])
    feed.add([click(spark, "10:06:00", "u")])
    feed.add([click(spark, "10:00:00", "late"), click(spark, "10:05:55", "in time"), click(spark, "10:10:00", "u")])
    clicks.start_valid_clicks(feed.stream(), out, str(tmp_path / "cp"), delay="30 seconds").awaitTermination()
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == ["in time", "u", "u"]


def test_blacklist_feeds_the_next_batch(spark, tmp_path):
    """Batch k leaves out who was listed before it and may list others; who is listed stays at that total."""
    valid = Feed(spark, tmp_path / "valid", clicks.COUNTS)
    listed, cp = (str(tmp_path / n) for n in ("listed", "cp"))
    clicks.create_blacklist(spark, listed, spark.createDataFrame([("known",)], "user_id string"))
    when = click(spark, "10:00:00", "u")[0]
    some = lambda user, n, ad="a": [(when, *click(spark, "10:00:00", user, ad)[1:], 1)] * n

    def run():
        rows = clicks.read_valid_clicks(spark, valid.path, maxFilesPerTrigger="1")
        clicks.start_totals(rows, listed, cp, threshold=2).awaitTermination()

    valid.add(some("u", 2) + some("v", 3) + some("known", 9))
    run()
    assert totals(clicks.read_totals(spark, listed)) == {("u", "a"): 2, ("v", "a"): 3}
    assert sorted(r.user_id for r in clicks.blacklist(spark, listed).collect()) == ["known", "v"]
    valid.add(some("u", 1) + some("v", 1) + some("w", 1))
    valid.add(some("u", 1) + some("u", 2, "b"))
    run()
    run()
    assert totals(clicks.read_totals(spark, listed)) == {("u", "a"): 3, ("v", "a"): 3, ("w", "a"): 1}
    assert sorted(r.user_id for r in clicks.blacklist(spark, listed).collect()) == ["known", "u", "v"]


def test_totals_over_many_files_equal_the_batch_chain(spark, tmp_path, folder):
    events = inputs.table(spark, folder, "events")
    feed = Feed(spark, tmp_path / "in", events.schema)
    ordered = events.orderBy("ts")
    edges = [r[0] for r in events.selectExpr("explode(percentile(event_id, array(0.25, 0.5, 0.75)))").collect()]
    for low, high in zip([-1, *edges], [*edges, 10**9]):
        feed.add(ordered.where((F.col("event_id") > low) & (F.col("event_id") <= high)))
    closing = str(tmp_path / "closing")
    rows = common.replay(spark, str(tmp_path / "in"), closing, maxFilesPerTrigger="1")
    banned = inputs.blacklist(spark, folder)
    valid, listed = (str(tmp_path / n) for n in ("valid", "listed"))
    start = lambda: clicks.start_valid_clicks(
        inputs.clicks_of(rows), valid, str(tmp_path / "cp1"), "1 hour", delay="1 hour"
    )
    common.run_closed(start, events, "ts", closing)
    clicks.create_blacklist(spark, listed, banned)
    clicks.start_totals(
        clicks.read_valid_clicks(spark, valid), listed, str(tmp_path / "cp2"), threshold=10**6
    ).awaitTermination()
    want = ops.ad_totals(inputs.clicks(spark, folder), banned, "1 hour")
    got = clicks.read_totals(spark, listed).where("user_id IS NOT NULL")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == want.count()


def passage_feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in", "value string")


def line(car, monitor, time, speed):
    return ("\t".join(["2024-01-05", monitor, "c", car, f"2024-01-05 {time}", speed, "1", "01"]),)


def test_road_state_from_text_lines(spark, tmp_path):
    """Both forms: each window once after the watermark, and the current value of every window."""
    feed = passage_feed(spark, tmp_path)
    feed.add([line("A", "m", "10:00:05", "60"), line("B", "m", "10:00:15", "80"), ("too\tshort",)])
    feed.add([line("C", "m", "10:00:18", "100"), line("D", "n", "10:00:18", "x")])
    feed.add([line("E", "m", "10:05:00", "10")])
    rows = parse_passages(feed.stream())
    closed, now = str(tmp_path / "closed"), str(tmp_path / "now")
    road.start_road_state(rows, closed, str(tmp_path / "cp1"), delay="0 seconds").awaitTermination()
    road.start_road_state_now(rows, now, str(tmp_path / "cp2"), delay="0 seconds").awaitTermination()
    everything = road.read_road_state_now(spark, now)

    def at(df, start, monitor="m"):
        row = df.where((F.date_format("window_start", "HH:mm:ss") == start) & (F.col("monitor_id") == monitor)).first()
        return row and (row.speed_sum, row.car_count, row.mean_speed)

    for df in (spark.read.parquet(closed), everything):
        assert at(df, "09:59:10") == (60, 1, 60.0)
        assert at(df, "09:59:20") == (240, 3, 80.0)
        assert at(df, "10:00:00") == (240, 3, 80.0)
        assert at(df, "10:00:10") == (180, 2, 90.0)
        assert at(df, "10:00:10", "n") == (None, 1, None)
    assert at(spark.read.parquet(closed), "10:05:00") is None
    assert at(everything, "10:05:00") == (10, 1, 10.0)


def test_watchlist_is_read_anew_for_every_batch(spark, tmp_path):
    feed = passage_feed(spark, tmp_path)
    wanted, out, cp = (str(tmp_path / n) for n in ("wanted", "out", "cp"))

    def run(cars):
        (tmp_path / "wanted").write_text("\n".join([*cars, "", " "]))
        rows = parse_passages(feed.stream())
        road.start_watchlist(rows, wanted, out, cp).awaitTermination()
        return sorted(r.car for r in store.read_all(spark, out, rows.schema).collect())

    feed.add([line("A", "m", "10:00:00", "1"), line("B", "m", "10:00:00", "1")])
    assert run(["A"]) == ["A"]
    feed.add([line("A", "m", "10:01:00", "1"), line("B", "m", "10:01:00", "1")])
    assert run(["B"]) == ["A", "B"]


def test_filter_reads_the_blacklist_anew(spark, tmp_path, feed):
    listed, out, cp = (str(tmp_path / n) for n in ("listed", "out", "cp"))

    def run():
        clicks.start_filter(feed.stream(), listed, out, cp).awaitTermination()
        return sorted(r.user_id for r in store.read_all(spark, out, feed.stream().schema).collect())

    feed.add([click(spark, "10:00:00", "u")])
    assert run() == ["u"]
    clicks.add_to_blacklist(spark, listed, spark.createDataFrame([("u",)], "user_id string"))
    feed.add([click(spark, "10:00:01", "u"), click(spark, "10:00:01", "v")])
    assert run() == ["u", "v"]


def test_active_users(spark, tmp_path, feed):
    out = str(tmp_path / "out")
    feed.add([click(spark, "10:00:01", "u"), click(spark, "10:00:02", "u"), click(spark, "10:00:03", "v")])
    feed.add([click(spark, "10:00:09", "u"), click(spark, "10:00:10", "u")])
    feed.add([click(spark, "10:05:00", "w")])
    clicks.start_active_users(feed.stream(), out, str(tmp_path / "cp")).awaitTermination()
    by_second = lambda df: {r.window_start.second: r.active_users for r in df.collect()}
    assert by_second(ops.count_users(spark.read.parquet(out))) == {0: 2, 10: 1}
    table = spark.read.schema(CLICK_SCHEMA).parquet(feed.path).where("user_id <> 'w'")
    assert by_second(ops.active_users(table)) == by_second(ops.count_sketched_users(ops.user_sketches(table))) == {0: 2, 10: 1}


def test_user_sketches_have_a_state_row_per_interval(spark, tmp_path, feed):
    feed.add([click(spark, f"10:00:{s:02}", f"u{i}") for s in (1, 11) for i in range(200)])
    feed.add([click(spark, "10:05:00", "w")])
    query = clicks.start_user_sketches(feed.stream(), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 3
    sketches = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.active_users for r in ops.count_sketched_users(sketches).collect()) == [200, 200]
    assert [r.active_users for r in ops.count_sketched_users(sketches, "1 minute").collect()] == [200]


def test_a_large_sketch_is_near(spark):
    users = spark.range(60000).selectExpr("timestamp'2024-01-05 10:00:00' event_ts", "cast(id % 40000 as string) user_id")
    n = ops.count_sketched_users(ops.user_sketches(users, lg_config=14)).first().active_users
    assert abs(n - 40000) <= 800


@pytest.fixture()
def stream_settings(spark):
    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    configure(spark, streams=True)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_state_on_disk(spark, tmp_path, feed, stream_settings):
    out = str(tmp_path / "out")
    feed.add([click(spark, "10:00:01", "u")])
    feed.add([click(spark, "10:05:00", "w")])
    query = clicks.start_valid_clicks(feed.stream(), out, str(tmp_path / "cp"))
    query.awaitTermination()
    assert [r.user_id for r in spark.read.parquet(out).collect()] == ["u"]
    assert "rocksdbCommitFlushLatency" in query.recentProgress[-1].json or "rocksdb" in query.recentProgress[-1].json


def test_console(spark, tmp_path, feed):
    feed.add([click(spark, "10:00:01", "u")])
    query = common.to_console(feed.stream(), str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.exception() is None and sum(p.numInputRows for p in query.recentProgress) == 1


def test_records(spark):
    lines = spark.createDataFrame(
        [("2024-01-05\tip\tu\ta\tP\tC\textra",), ("a\tb",), ("",)], "value string"
    )
    assert [r.city for r in parse_clicks(lines, keep=()).collect()] == ["C"]
    users = spark.createDataFrame([("2024-01-05 page u7 more",), ("one two",)], "value string")
    assert [r.user_id for r in parse_active_users(users, keep=()).collect()] == ["u7"]
    assert parse_passages(spark.createDataFrame([line("A", "m", "10:00:00", "1")], "value string")).columns == [
        *PASSAGE_FIELDS, "event_ts",
    ]


@pytest.mark.parametrize("form", ["8 files", "one file a batch"])
@pytest.mark.parametrize("name", ["stream_road_state", "stream_ad_valid", "stream_watchlist", "stream_active_users"])
def test_replays_read_every_file_of_a_table(spark, folder, con, tmp_path, name, form, monkeypatch):
    from compare import check

    from roadlens.plans import oracle, queries

    copy = tmp_path / "tables"
    copy.mkdir()
    for table in ("customer", "supplier"):
        (copy / f"{table}.parquet").symlink_to(f"{folder}/{table}.parquet")
    events, target = inputs.table(spark, folder, "events"), str(copy / "events.parquet")
    edges = [r[0] for r in events.selectExpr("explode(percentile_approx(ts, array(0.2, 0.4, 0.6, 0.8)))").collect()]
    for low, high in zip([None, *edges], [*edges, None]):
        after = F.lit(True) if low is None else F.col("ts") > F.lit(low)
        until = F.lit(True) if high is None else F.col("ts") <= F.lit(high)
        events.where(after & until).coalesce(1 if form != "8 files" else 2).write.mode("append").parquet(target)
        time.sleep(0.05)  # files are read in the order of their times
    if form != "8 files":
        monkeypatch.setattr(queries, "REPLAY", {"maxFilesPerTrigger": "1"})
    assert check(queries.QUERIES[name](spark, str(copy)), con, oracle.ORACLE[name]) > 0


def test_a_replay_of_nothing_fails(spark, tmp_path):
    with pytest.raises(Exception):
        common.replay(spark, str(tmp_path / "missing"))


def test_mean_speed_leaves_out_what_is_no_number(spark):
    rows = spark.createDataFrame([("m", "10"), ("m", "x"), ("n", "x")], "monitor_id string, speed string")
    rows = rows.withColumn("event_ts", F.lit("2024-01-05 10:00:01").cast("timestamp"))
    got = {(r.monitor_id, r.car_count, r.mean_speed) for r in road.road_state(rows).collect()}
    assert got == {("m", 2, 10.0), ("n", 1, None)}


def test_a_store_of_another_checkpoint_is_refused(spark, tmp_path):
    """A new checkpoint numbers its batches from 0 again and would answer with old totals."""
    valid = Feed(spark, tmp_path / "valid", clicks.COUNTS)
    listed = str(tmp_path / "listed")
    when = click(spark, "10:00:00", "u")[0]
    valid.add([(when, *click(spark, "10:00:00", "u")[1:], 1)] * 2)

    def run(cp):
        clicks.start_totals(clicks.read_valid_clicks(spark, valid.path), listed, str(tmp_path / cp)).awaitTermination()

    run("cp")
    run("cp")
    with pytest.raises(ValueError):
        run("new")
    assert totals(clicks.read_totals(spark, listed)) == {("u", "a"): 2}


def test_active_users_leave_out_who_is_listed_between_batches(spark, tmp_path, feed):
    listed, out, cp = (str(tmp_path / n) for n in ("listed", "out", "cp"))

    def run():
        clicks.start_active_users(feed.stream(), out, cp, blacklist_path=listed).awaitTermination()
        return sorted((r.window_start.minute, r.user_id) for r in spark.read.parquet(out).collect())

    feed.add([click(spark, "10:00:01", "u"), click(spark, "10:00:01", "v")])
    feed.add([click(spark, "10:05:00", "u"), click(spark, "10:05:00", "v")])
    assert run() == [(0, "u"), (0, "v")]
    clicks.add_to_blacklist(spark, listed, spark.createDataFrame([("u",)], "user_id string"))
    feed.add([click(spark, "10:10:00", "w")])
    assert run() == [(0, "u"), (0, "v"), (5, "v")]


def test_stream_jobs_from_the_command_line(spark, tmp_path, stream_settings):
    from roadlens.__main__ import main

    folder = tmp_path / "lines"
    folder.mkdir()

    def put(name, minute, *rows):
        (folder / name).write_text("".join(f"{r}\n" for r in rows))
        at = 1_700_000_000 + 60 * minute
        os.utime(folder / name, (at, at))

    def run(job, *more):
        main([job, "--lines", str(folder), "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "cp"), *more])

    def read(name):
        return spark.read.parquet(str(tmp_path / "out" / name))

    put("roads1", 0, line("A", "m", "10:00:05", "60")[0], line("B", "m", "10:00:06", "80")[0])
    put("roads2", 1, line("C", "m", "10:09:00", "60")[0])
    (tmp_path / "wanted").write_text("B\n")
    for _ in range(2):  # a pass first raises the watermark, the next gives out what it has passed
        run("stream-roads", "--watchlist", str(tmp_path / "wanted"), "--print", "--option", "pathGlobFilter=roads*")
    assert {(r.speed_sum, r.car_count) for r in read("road_state").collect()} == {(140, 2)}
    assert [r.car for r in read("wanted").collect()] == ["B"]

    listed = ["--blacklist", str(tmp_path / "listed")]
    put("clicks1", 0, *["\t".join(["2024-01-05", f"ip{i}", "u", "a", "P", "C"]) for i in range(3)])
    put("clicks2", 9, "\t".join(["2024-01-05", "ip", "v", "a", "P", "C"]))
    for _ in range(2):
        run("stream-clicks", *listed, "--threshold", "2", "--option", "pathGlobFilter=clicks*")
    assert totals(clicks.read_totals(spark, str(tmp_path / "listed"))) == {("u", "a"): 3}
    put("users1", 0, "2024-01-05 page u", "2024-01-05 page w", "2024-01-05 page w")
    put("users2", 9, "2024-01-05 page x")
    run("stream-users", *listed, "--option", "pathGlobFilter=users*")
    assert [r.user_id for r in read("active_users").collect()] == ["w"]
    with pytest.raises(SystemExit):
        run("stream-users")
