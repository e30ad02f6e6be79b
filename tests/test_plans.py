"""What the plans must and must not contain."""

import pytest

from roadlens.plans.queries import QUERIES

BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture()
def without_broadcast(spark):
    """Plans as they are when every side is too large to broadcast by its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, folder, without_broadcast, name):
    text = plan(QUERIES[name](spark, folder))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "FlatMapGroups"):
        assert word not in text


@pytest.mark.parametrize("name", ["area_top3_roads", "speed_top10_details"])
def test_ranks_are_cut_before_the_shuffle(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "row_number(), 3, Partial" in text or "row_number(), 10, Partial" in text


@pytest.mark.parametrize("name", ["topn_monitors", "speed_top_monitors"])
def test_top_n_keeps_n_rows_per_task(spark, folder, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", ["enrich_area", "filter_watched_cars", "topn_monitor_details", "semi_top_monitors"])
def test_small_sides_are_broadcast_by_their_size(spark, folder, without_broadcast, name):
    assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, folder))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    assert "BroadcastHashJoin" in plan(QUERIES[name](spark, folder))


KEYED = ["car_track", "car_track_times", "flow_prefix_counts", "monitor_5min_cars_all", "sampled_car_tracks"]


@pytest.mark.parametrize("name", KEYED)
def test_hot_keys_leave_the_direct_way(spark, folder, without_broadcast, name):
    """The direct way has an anti-join with the hot keys, the other one goes by slices of them."""
    text = plan(QUERIES[name](spark, folder))
    assert text.count("LeftAnti, BuildRight") == 1 and "LeftSemi, BuildRight" in text
    assert text.count("Exchange hashpartitioning(_group#") == 2


@pytest.mark.parametrize("name", KEYED)
def test_without_hot_keys_the_second_way_vanishes(spark, folder, name):
    df = QUERIES[name](spark, folder)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "_group#" not in final and "Union" not in final


def test_ranking_in_slices_sorts_rows_once(spark, folder, without_broadcast):
    """One sort of the hot rows by (group, time), one of the offsets by group."""
    assert plan(QUERIES["car_track"](spark, folder)).count("Sort [_group#") == 2


@pytest.mark.parametrize("name", ["hourly_distinct_cars", "speed_bands", "area_road_flow"])
def test_scans_read_only_needed_columns(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "event" in line or "ts#" in line)
    unused = {"hourly_distinct_cars": "props", "speed_bands": "user_id", "area_road_flow": "value"}[name]
    assert unused not in scan.split("FileScan parquet")[-1].split("]")[0]


def test_date_range_prunes_partitions(spark, folder, tmp_path):
    from roadlens.operators.filters import by_date
    from roadlens.plans import inputs
    from roadlens.sinks.tables import write_partitioned
    from roadlens.sources.tables import read_passages

    path = str(tmp_path / "passages")
    write_partitioned(inputs.passages(spark, folder), path)
    days = by_date(read_passages(spark, path), "2024-01-05", "2024-01-06")
    text = plan(days.groupBy("monitor_id").count())
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan and "ReadSchema: struct<monitor_id:string>" in scan
    assert days.count() == by_date(inputs.passages(spark, folder), "2024-01-05", "2024-01-06").count()


def test_monitor_flow_reads_the_fact_three_times(spark, folder, tmp_path, monkeypatch):
    """One pass counts for all four results; two of them read the passages they list."""
    from roadlens.plans import inputs, jobs
    from roadlens.sinks import store
    from roadlens.sources.tasks import JobParams

    path = str(tmp_path / "fact")
    inputs.passages(spark, folder).withColumnRenamed("event_id", "only_in_the_fact").write.parquet(path)
    plans, staged = [], store.staged

    def seen(df, name):
        plans.append(plan(df, "optimizedPlan"))
        return staged(df, name)

    monkeypatch.setattr(store, "staged", seen)
    params = JobParams(1, "2024-01-01", "2024-12-31", top_num=3)
    results = jobs.monitor_flow(spark.read.parquet(path), inputs.roster(spark, folder), params)
    plans += [plan(df, "optimizedPlan") for df in results.values()]
    assert sum("only_in_the_fact" in line and "Relation" in line for text in plans for line in text.splitlines()) == 3


def companions_plan(spark, folder, broadcast_rows):
    from roadlens.operators.tracks import companions
    from roadlens.plans import inputs

    return plan(companions(inputs.passages(spark, folder), inputs.watchlist(spark, folder), broadcast_rows=broadcast_rows))


def test_few_buckets_of_wanted_cars_are_broadcast(spark, folder, without_broadcast):
    text = companions_plan(spark, folder, 1_000_000)
    assert "Exchange hashpartitioning(monitor_id" not in text and "Inner, BuildRight" in text and "cell#" not in text


def test_passages_that_meet_no_wanted_car_leave_before_the_shuffle(spark, folder, without_broadcast):
    text = companions_plan(spark, folder, 0)
    shuffle = text.index("Exchange hashpartitioning(monitor_id")
    assert "BroadcastHashJoin [cell#" in text[shuffle:] and "LeftSemi, BuildRight" in text[shuffle:]


def test_hot_ranges_are_counted_without_the_shuffle_by_car(spark, folder, monkeypatch):
    from roadlens.operators import ordering

    plans, staged = [], ordering.store.staged
    monkeypatch.setattr(ordering.store, "staged", lambda df, name: plans.append(plan(df)) or staged(df, name))
    QUERIES["monitor_5min_cars"](spark, folder)
    assert [text.count("Exchange hashpartitioning") for text in plans] == [1] and "car#" not in plans[0]


def test_offsets_of_a_hot_key_run_over_days_and_over_seconds(spark):
    """Ten years of one key: no window of the two levels has all its seconds."""
    from pyspark.sql import functions as F

    from roadlens.operators.ordering import slice_offsets

    rows = spark.range(200_000).selectExpr("'hot' k", "pmod(xxhash64(id), 315360000) second")
    span = F.floor(F.col("second") / 86400)
    two, one = slice_offsets(rows, ["k"], F.col("second"), span), slice_offsets(rows, ["k"], F.col("second"))
    assert two.exceptAll(one).count() == 0 and two.count() == one.count()
    text = plan(two, "optimizedPlan")
    assert text.count("Window [") == 2 and "windowspecdefinition(_span#" in text.replace("(_span.k", "(_key")
    assert rows.groupBy(span.alias("d")).agg(F.count_distinct("second").alias("n")).agg(F.max("n")).first()[0] <= 86400
