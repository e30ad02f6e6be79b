"""Logs of commits: batches run again, killed runs, two writers, merging, and what is kept in them."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.operators import clicks as ops
from roadlens.operators import tracks
from roadlens.schema import PASSAGE_FIELDS
from roadlens.sinks import car_lists
from roadlens.sinks import log as logs
from roadlens.sinks.log import Log, Table
from roadlens.streaming import clicks, common, road

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
TABLES = {"newest": Table(SCHEMA, ("k",)), "sets": Table(SCHEMA, ("k",), sets=True), "every": Table(SCHEMA)}


@pytest.fixture()
def log(spark, tmp_path):
    return Log(spark, f"file://{tmp_path}/log", TABLES)


def add(log, rows, batch=None, names=TABLES):
    df = log.spark.createDataFrame(rows, SCHEMA)
    log.commit({n: log.write(n, df) for n in names}, batch)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_newest_rows_sets_and_all_rows(log):
    assert rows(log.read("newest")) == []
    add(log, [("a", 1), ("a", 2), ("b", 1)])
    add(log, [("a", 1), (None, 5)])
    assert rows(log.read("newest")) == [("a", 1), ("b", 1), (None, 5)]
    assert rows(log.read("sets")) == [("a", 1), ("b", 1), (None, 5)]
    assert len(rows(log.read("every"))) == 5
    assert rows(log.read("newest", log.commit_at(0))) == [("a", 2), ("b", 1)]
    assert rows(log.read("newest", where=F.col("k") == "b")) == [("b", 1)]


def test_a_batch_run_again_adds_nothing(log):
    for batch in (0, 0, 1, 1, 0):
        add(log, [("a", batch)], batch)
    assert rows(log.read("every")) == [("a", 0), ("a", 1)]
    assert log.done(1) and not log.done(2)


def test_a_run_killed_before_its_commit_leaves_no_half_state(log):
    add(log, [("a", 1)], 0)
    log.write("newest", log.spark.createDataFrame([("a", 2)], SCHEMA))  # and then nothing more
    assert rows(log.read("newest")) == rows(log.read("every")) == [("a", 1)]
    add(log, [("a", 2)], 1)
    assert rows(log.read("newest")) == [("a", 2)]
    assert log.remove_unnamed() == 1 and rows(log.read("every")) == [("a", 1), ("a", 2)]


def test_two_writers_lose_nothing(log, spark):
    other = Log(spark, log.path, TABLES)
    put, between = log._put, iter([True])

    def late(commit):
        if next(between, False):
            add(other, [("b", 1)], names=["newest"])
        return put(commit)

    log._put = late
    add(log, [("a", 1)], names=["newest"])
    assert rows(log.read("newest")) == [("a", 1), ("b", 1)]
    assert log.last().number == 1


def test_an_owner_keeps_others_out(log):
    log.claim("one")
    log.claim("one")
    with pytest.raises(ValueError):
        log.claim("two")


def test_fifty_batches_keep_the_folders_few(log):
    state, most = {}, 0
    rng = random.Random(1)
    for batch in range(50):
        new = {rng.choice("abcdefghij"): batch for _ in range(3)}
        state |= new
        add(log, list(new.items()), batch, ["newest"])
        most = max(most, len(log.last().tables["newest"]))
    assert rows(log.read("newest")) == sorted(state.items())
    assert most <= 2 * logs.FANOUT
    # folders that the last commits name: some of the last batches, and merged ones
    assert len(log._names("data")) <= 3 * logs.FANOUT + logs.KEEP
    assert len(log._numbers()) <= logs.KEEP + 1 and log.remove_unnamed() == 0


# --- totals of clicks


def valid_rows(spark, days):
    return spark.createDataFrame(
        [(f"{at} 10:00:00", "ip", user, "a", "P", "C", day, 1) for at, day, user in days],
        "t string, ip string, user_id string, ad_id string, province string, city string, click_date string, n long",
    ).select(F.col("t").cast("timestamp").alias("window_start"), *[f for f in clicks.COUNTS.names if f not in ("window_start", "n")], "n")


def totals_run(spark, tmp_path, threshold=2):
    valid = clicks.read_valid_clicks(spark, str(tmp_path / "valid"), maxFilesPerTrigger="1")
    query = clicks.start_totals(valid, str(tmp_path / "log"), str(tmp_path / "cp"), threshold)
    query.awaitTermination()
    return query


def add_valid(spark, tmp_path, days):
    valid_rows(spark, days).coalesce(1).write.mode("append").parquet(str(tmp_path / "valid"))


def found(spark, tmp_path):
    got = clicks.read_totals(spark, str(tmp_path / "log"))
    return {(r.click_date, r.user_id): r.clicked_count for r in got.collect()}


def test_state_of_totals_ends_and_totals_stay(spark, tmp_path):
    sizes = []
    for day in range(1, 13):
        add_valid(spark, tmp_path, [(f"2024-01-{day:02}", f"2024-01-{day:02}", f"u{i}") for i in range(5)])
        query = totals_run(spark, tmp_path, 99)
        sizes.append(query.recentProgress[-1].stateOperators[0].numRowsTotal)
    assert max(sizes) <= 5 * 3  # today, and what the watermark has not passed
    assert found(spark, tmp_path) == {(f"2024-01-{d:02}", f"u{i}"): 1 for d in range(1, 13) for i in range(5)}


def test_a_total_counts_clicks_of_other_days_of_events(spark, tmp_path):
    """The day in the click is not that of its event; the sum over both decides on the blacklist."""
    add_valid(spark, tmp_path, [("2024-01-05", "2024-01-05", "u"), ("2024-01-05", "2024-01-05", "v")])
    totals_run(spark, tmp_path)
    add_valid(spark, tmp_path, [("2024-01-06", "2024-01-05", "u")] * 2)
    totals_run(spark, tmp_path)
    assert found(spark, tmp_path) == {("2024-01-05", "u"): 3, ("2024-01-05", "v"): 1}
    assert [r.user_id for r in clicks.blacklist(spark, str(tmp_path / "log")).collect()] == ["u"]


def test_a_batch_killed_before_its_commit_is_made_up_for(spark, tmp_path, monkeypatch):
    add_valid(spark, tmp_path, [("2024-01-05", "2024-01-05", "u")] * 3)
    commit = Log.commit

    def killed(self, added, batch=None):
        raise RuntimeError("killed")

    monkeypatch.setattr(Log, "commit", killed)
    with pytest.raises(Exception, match="killed"):
        totals_run(spark, tmp_path)
    assert found(spark, tmp_path) == {} and clicks.blacklist(spark, str(tmp_path / "log")).count() == 0

    def late(self, added, batch=None):  # the log has the batch, but the stream's own commit is missing
        commit(self, added, batch)
        raise RuntimeError("killed")

    monkeypatch.setattr(Log, "commit", late)
    with pytest.raises(Exception, match="killed"):
        totals_run(spark, tmp_path)
    monkeypatch.setattr(Log, "commit", commit)
    add_valid(spark, tmp_path, [("2024-01-05", "2024-01-05", "v")])
    totals_run(spark, tmp_path)
    assert found(spark, tmp_path) == {("2024-01-05", "u"): 3, ("2024-01-05", "v"): 1}
    assert [r.user_id for r in clicks.blacklist(spark, str(tmp_path / "log")).collect()] == ["u"]


def test_a_batch_run_again_sees_the_list_it_saw(spark, tmp_path, monkeypatch):
    from roadlens.sinks import store

    records = spark.createDataFrame([("u",), ("v",)], "user_id string")
    records.coalesce(1).write.parquet(str(tmp_path / "in"))
    listed, out, put = str(tmp_path / "listed"), str(tmp_path / "out"), store.put
    users = lambda *names: spark.createDataFrame([(n,) for n in names], "user_id string")
    clicks.create_blacklist(spark, listed, users("x"))

    def run():
        rows = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
        clicks.start_filter(rows, listed, out, str(tmp_path / "cp")).awaitTermination()

    def killed(rows, path, batch):
        put(rows.limit(1), path, batch)
        raise RuntimeError("killed")

    monkeypatch.setattr(store, "put", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(store, "put", put)
    clicks.add_to_blacklist(spark, listed, users("u"))
    run()
    found = lambda: sorted(r.user_id for r in store.read_all(spark, out, records.schema).collect())
    assert found() == ["u", "v"]
    records.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert found() == ["u", "v", "v"]


# --- panes


def test_one_state_row_per_pane(spark, tmp_path):
    stamps = [f"2024-01-05 10:00:{s:02}" for s in (1, 2, 11, 12, 25)]
    table = spark.createDataFrame([(t, "m", str(i)) for i, t in enumerate(stamps)], "t string, monitor_id string, speed string")
    table = table.select(F.col("t").cast("timestamp").alias("event_ts"), "monitor_id", "speed")
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    query = road.start_road_state_now(common.replay(spark, str(tmp_path / "in")), str(tmp_path / "log"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) == 3
    got, want = road.read_road_state_now(spark, str(tmp_path / "log")), road.road_state(table)
    assert rows(got) == rows(want) and got.count() == 8
    late = road.read_road_state_now(spark, str(tmp_path / "log"), since="2024-01-05 10:00:20")
    assert {(r.speed_sum, r.car_count) for r in late.collect()} == {(4, 1)}


# --- lists of cars


def passages_of(spark, n, seed):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        time = f"2024-01-05 {rng.choice([9, 10, 25])}:{rng.randrange(60):02}:{rng.randrange(60):02}"
        car, monitor = rng.choice(["A", "B", "C", "D", None]), rng.choice(["m", "n", "o"])
        made.append((i, "2024-01-05", monitor, str(i % 3), car, rng.choice([time, time, "no time"]), "50", "1", "01"))
    return spark.createDataFrame(made, "event_id long, " + ", ".join(f"{f} string" for f in PASSAGE_FIELDS))


@pytest.mark.parametrize("last_only", [True, False])
def test_runs_over_parts_end_with_the_lists_of_all(spark, tmp_path, last_only):
    table, path = passages_of(spark, 150, 3), f"file://{tmp_path}/lists"
    for i, part in enumerate((2, 0, 1)):
        car_lists.add_passages(path, table.where(F.col("event_id") % 3 == part), last_only, ("event_id",), run=i)
    want = rows(tracks.monitor_5min_cars(table, last_only, ("event_id",)).select("monitor_id", "range_time", "part", "cars"))
    assert rows(car_lists.read_lists(spark, path)) == want
    car_lists.add_passages(path, table.where("event_id % 3 = 1"), last_only, ("event_id",), run=2)
    assert rows(car_lists.read_lists(spark, path)) == want


def test_only_changed_groups_are_written(spark, tmp_path):
    import pathlib

    path = f"file://{tmp_path}/lists"
    seen = lambda monitor, car, time: (0, "2024-01-05", monitor, "1", car, f"2024-01-05 {time}", "50", "1", "01")
    make = lambda rows: spark.createDataFrame(rows, "event_id long, " + ", ".join(f"{f} string" for f in PASSAGE_FIELDS))
    car_lists.add_passages(path, make([seen("m", "A", "10:01:00"), seen("m", "B", "10:02:00"), seen("n", "A", "10:00:00"), seen("m", "C", "10:20:00")]))
    files = lambda: {f: f.stat().st_mtime_ns for f in pathlib.Path(tmp_path, "lists/data").rglob("*.parquet")}
    before = files()
    car_lists.add_passages(path, make([seen("m", "A", "10:31:00"), seen("m", "B", "10:01:00"), seen("m", "C", "10:40:00")]))
    assert before.items() <= files().items()
    log = car_lists._log(spark, path)
    written = log.rows("lists").where(F.col("commit") == log.last().number)
    label = lambda a, b: f"2024-01-05 10:{a}~2024-01-05 10:{b}"
    assert rows(written.select("range_time", "cars")) == [
        (label("00", "05"), "B=2024-01-05 10:02:00"), (label("20", "25"), None), (label("30", "35"), "A=2024-01-05 10:31:00"),
        (label("40", "45"), "C=2024-01-05 10:40:00"),
    ]
    assert {r.range_time for r in car_lists.read_lists(spark, path).where("monitor_id = 'n'").collect()} == {label("00", "05")}
    assert label("20", "25") not in {r.range_time for r in car_lists.read_lists(spark, path).collect()}


def test_lists_in_parts(spark, tmp_path):
    table, path = passages_of(spark, 120, 5), f"file://{tmp_path}/lists"
    for day in (0, 1):
        car_lists.add_passages(path, table.where(F.col("event_id") % 2 == day), False, ("event_id",), hot_rows=2, part_rows=2)
    want = tracks.monitor_5min_cars(table, False, ("event_id",), hot_rows=2, part_rows=2)
    assert rows(car_lists.read_lists(spark, path)) == rows(want.select("monitor_id", "range_time", "part", "cars"))


def test_summed_totals(spark):
    some = spark.createDataFrame([("d", "u", "a", 1), ("d", "u", "a", 2)], "click_date string, user_id string, ad_id string, clicked_count long")
    assert rows(ops.summed(some)) == [("d", "u", "a", 3)]
