"""Hand-made cases with results worked out by hand."""

import pytest

from roadlens.operators import areas, clicks, filters, funnel, monitors, sampling, tracks


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def at(minute, second=0, hour=12, day=5):
    return f"2024-01-{day:02d} {hour:02d}:{minute:02d}:{second:02d}"


def test_flow_on_a_track(make_passages):
    p = make_passages([("C1", m, at(i)) for i, m in enumerate("12367812")])
    rows = by(funnel.flow_prefix_counts(p, list("12345")), "step")
    assert [rows[i].cnt for i in range(1, 6)] == [2, 2, 1, 0, 0]
    rates = {r.flow: r.rate for r in funnel.flow_convert_rate(p, list("12345")).collect()}
    assert rates == {"1,2": 1.0, "1,2,3": 0.5, "1,2,3,4": 0.0}


def test_flow_counts_overlaps(make_passages):
    p = make_passages([("C1", "1", at(i)) for i in range(3)])
    rows = by(funnel.flow_prefix_counts(p, ["1", "1"]), "step")
    assert [rows[i].cnt for i in (1, 2)] == [3, 2]


def test_flow_without_passages(make_passages):
    p = make_passages([("C1", "9", at(0))])
    assert [r.cnt for r in funnel.flow_prefix_counts(p, ["1", "2"]).orderBy("step").collect()] == [0, 0]
    assert funnel.flow_convert_rate(p, ["1", "2"]).collect() == []


def health(spark, make_passages, listed, seen, rule="count"):
    roster = spark.createDataFrame([("m", x) for x in listed], "monitor_id string, camera_id string")
    p = make_passages([("C1", "m", at(i), x) for i, x in enumerate(seen)] or [("C1", "other", at(0), "z")])
    return tuple(monitors.monitor_state(monitors.monitor_health(roster, p, rule)).first())


@pytest.mark.parametrize(
    "listed, seen, rule, want",
    [
        ("ab", "a", "count", (0, 1, 1, 1, "m:b")),
        ("ab", "", "count", (0, 0, 1, 2, "m:a,b")),
        ("a", "b", "count", (1, 1, 0, 0, "")),
        ("a", "b", "set", (0, 0, 1, 1, "m:a")),
        ("a", "ab", "count", (0, 1, 1, 0, "")),
        ("ab", "abba", "set", (1, 2, 0, 0, "")),
    ],
)
def test_camera_health(spark, make_passages, listed, seen, rule, want):
    assert health(spark, make_passages, listed, seen, rule) == want


def test_unknown_rule(spark, make_passages):
    with pytest.raises(ValueError):
        health(spark, make_passages, "a", "a", "other")


def test_speed_order_is_by_level(spark):
    bands = spark.createDataFrame(
        [("x", 9, 9, 9, 0), ("y", 0, 0, 0, 1), ("z", 0, 0, 0, 1)],
        "monitor_id string, low_count long, normal_count long, medium_count long, high_count long",
    )
    assert [r.monitor_id for r in monitors.fastest_monitors(bands, 3).collect()] == ["y", "z", "x"]


def test_fastest_passages_of_a_quiet_monitor(make_passages):
    p = make_passages([("C1", "m", at(0), "0", "80"), ("C2", "m", at(1), "0", "x"), ("C3", "m", at(2), "0", "200")])
    rows = by(monitors.fastest_passages(p, p.select("monitor_id").distinct()), "rn")
    assert [rows[i].car for i in (1, 2, 3)] == ["C3", "C1", "C2"]


@pytest.mark.parametrize("top_n", [1, 3, 5, 9])
def test_fastest_passages_by_hand(make_passages, top_n):
    speeds = ["80", "90", "x", "90", "80", "7", "90", None]
    rows = [(f"C{i}", m, at(i), "0", s) for m in "mn" for i, s in enumerate(speeds if m == "m" else speeds[2:5])]
    p = make_passages(rows)
    got = monitors.fastest_passages(p, p.select("monitor_id").distinct(), top_n).collect()
    for m in "mn":
        key = lambda r: (r[4] in ("x", None), -int(r[4] if r[4] not in ("x", None) else 0), r[2])
        want = [r[0] for r in sorted((r for r in rows if r[1] == m), key=key)][:top_n]
        assert [r.car for r in sorted(got, key=lambda r: r.rn) if r.monitor_id == m] == want


def test_non_numeric_speed_is_in_no_band(make_passages):
    p = make_passages([("C1", "m", at(0), "0", s) for s in ("x", "-1", "0", "59", "60", "90", "120")])
    assert tuple(monitors.speed_bands(p).first()) == ("m", 2, 1, 1, 1)


def test_frequency_map_merges_areas_of_one_name(spark, make_passages):
    p = make_passages(
        [("C1", "0001", at(0), "0", "50", "1", "01")] * 2
        + [("C1", "0002", at(0), "0", "50", "1", "02"), ("C1", "0001", at(0), "0", "50", "1", "02")]
    )
    dims = spark.createDataFrame([("01", "N"), ("02", "N")], "area_id string, area_name string")
    want = [("N", "1", 4, "0001=3|0002=1")]
    assert [tuple(r) for r in areas.area_road_flow(p, dims).collect()] == want
    assert [tuple(r) for r in areas.area_road_flow_salted(p, dims).collect()] == want


def test_inclusive_and_exclusive_ranges(make_passages):
    p = make_passages([("C1", "m", at(0, day=d)) for d in (4, 5, 6, 7)])
    assert filters.by_date(p, "2024-01-05", "2024-01-06").count() == 2
    kept = filters.by_time_and_monitors(p, at(0, day=4), at(0, day=7), ["m"])
    assert sorted(r.date for r in kept.collect()) == ["2024-01-05", "2024-01-06"]


def test_track_in_lenient_time_order(make_passages):
    p = make_passages([("C1", "a", "2024-01-05 26:10:00"), ("C1", "b", "2024-01-06 01:00:00"), ("C1", "c", at(0))])
    assert tuple(tracks.car_track(p).first()) == ("C1", 0, "2024-01-05", "c,b,a")
    times = tracks.car_track_times(p).first().track
    assert times == "c=2024-01-05 12:00:00|b=2024-01-06 01:00:00|a=2024-01-05 26:10:00"


def test_rows_without_a_car_stay(make_passages):
    p = make_passages([(None, "a", at(0)), (None, "b", at(1)), ("C1", "c", at(0))])
    assert {r.car: r.track for r in tracks.car_track(p).collect()} == {None: "a,b", "C1": "c"}


def test_last_visit_only(make_passages):
    p = make_passages([("C1", "m1", at(1)), ("C1", "m1", at(31)), ("C2", "m1", at(33))])
    day = "2024-01-05 "
    late = {f"{day}12:30~{day}12:35": f"C1={at(31)}|C2={at(33)}"}
    assert {r.range_time: r.cars for r in tracks.monitor_5min_cars(p).collect()} == late
    both = {f"{day}12:00~{day}12:05": f"C1={at(1)}", **late}
    assert {r.range_time: r.cars for r in tracks.monitor_5min_cars(p, last_only=False).collect()} == both


def test_stored_and_new_visits_make_one_list(make_passages):
    old = tracks.range_visits(make_passages([("C1", "m", at(1))]))
    new = tracks.range_visits(make_passages([("C2", "m", at(2))]))
    assert tracks.cars_per_range(old.unionByName(new)).first().cars == f"C1={at(1)}|C2={at(2)}"


def test_quota(make_passages):
    rows = [(f"C{i}", "m", at(i % 60, hour=8 + i % 2, day=5 + i // 200)) for i in range(400)]
    quota = by(sampling.sample_quota(make_passages(rows), 101), "date", "hour")
    assert {k: (r.per_day, r.quota) for k, r in quota.items()} == {
        (f"2024-01-0{d}", h): (50, 25) for d in (5, 6) for h in ("08", "09")
    }
    assert all(r.quota == r.cars for r in sampling.sample_quota(make_passages(rows), 10**6).collect())


def test_sample_of_nothing(make_passages):
    p = make_passages([("C1", "m", at(0))]).where("false")
    assert sampling.sample_cars(p, 10).collect() == [] and sampling.sample_quota(p, 10).collect() == []


def clicks_at(spark, *rows):
    data = [(at(*t), "2024-01-05", "ip", u, a, "P", "C") for t, u, a in rows]
    schema = "t string, click_date string, ip string, user_id string, ad_id string, province string, city string"
    return spark.createDataFrame(data, schema).selectExpr("cast(t AS timestamp) AS event_ts", "* EXCEPT (t)")


def test_repeated_clicks_go_away(spark):
    df = clicks_at(spark, ((0, 1), "u", "a"), ((0, 2), "u", "a"), ((0, 11), "u", "a"), ((0, 1), "v", "a"))
    valid = clicks.valid_clicks(clicks.click_counts(df))
    assert sorted((r.user_id, r.window_start.second) for r in valid.collect()) == [("u", 10), ("v", 0)]


def test_blacklist_excludes_and_grows(spark):
    totals = spark.createDataFrame(
        [("d", "u1", "a", 50), ("d", "u2", "a", 51), ("d", "u2", "b", 99), ("d", "u3", "a", 51)],
        "click_date string, user_id string, ad_id string, clicked_count long",
    )
    known = spark.createDataFrame([("u3",)], "user_id string")
    assert [r.user_id for r in clicks.new_blacklist(totals, 50, known).collect()] == ["u2"]
    kept = clicks.without_blacklisted(totals, known)
    assert sorted({r.user_id for r in kept.collect()}) == ["u1", "u2"]
