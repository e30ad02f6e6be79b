"""One key with a third of all rows or more: results stay whole, and no group grows with the key."""

from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadlens.operators import areas, funnel, sampling, tracks
from roadlens.operators.ordering import number_within, ordered_lists


def text(sec):
    return f"2024-01-{5 + sec // 86400:02d} {sec // 3600 % 24:02d}:{sec // 60 % 60:02d}:{sec % 60:02d}"


def rows_with_hot_car(n=900):
    """A third of the rows belongs to car HOT and a third to checkpoint m0; several passages share a second."""
    rows = []
    for i in range(n):
        car = "HOT" if i % 3 == 0 else f"C{i * 7 % 40:02d}"
        monitor = "m0" if i % 3 == 1 else f"m{i * 5 % 7}"
        rows.append((car, monitor, text(i * 977 % 172800 // 2 * 2)))
    return rows


def tracks_by_hand(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] or "", rows[i][2], i))
    return {
        car: [(rows[i][1], rows[i][2]) for i in items] for car, items in groupby(order, key=lambda i: rows[i][0])
    }


@pytest.mark.parametrize("hot_rows", [10, 10**6])
@pytest.mark.parametrize("part_rows", [1, 10, 100, 10**6])
def test_tracks_in_parts(make_passages, part_rows, hot_rows):
    """The parts follow from part_rows alone, whatever is taken for hot."""
    rows = rows_with_hot_car()
    got = tracks.car_track_times(make_passages(rows), ["event_id"], hot_rows, part_rows).collect()
    want = tracks_by_hand(rows)
    assert max(r.track.count("|") for r in got) == max(min(part_rows, len(t)) for t in want.values()) - 1
    joined = {}
    for r in sorted(got, key=lambda r: (r.car, r.part)):
        assert r.part == len(joined.setdefault(r.car, [])) // part_rows
        joined[r.car] += [tuple(x.split("=")) for x in r.track.split("|")]
    assert joined == want


def test_date_of_a_part_is_that_of_its_last_passage(make_passages):
    rows = rows_with_hot_car()
    got = {(r.car, r.part): r.date for r in tracks.car_track(make_passages(rows), ["event_id"], 50, 10).collect()}
    for car, track in tracks_by_hand(rows).items():
        for part in range(0, len(track), 10):
            assert got.pop((car, part // 10)) == track[part : part + 10][-1][1][:10]
    assert not got


@pytest.mark.parametrize("hot_rows, slice_seconds", [(0, 1), (0, 600), (0, 10**6), (50, 600), (10**6, 600)])
def test_positions_do_not_depend_on_the_slices(make_passages, hot_rows, slice_seconds):
    rows = rows_with_hot_car(300) + [(None, "m1", text(i)) for i in range(60)]
    numbered = tracks.in_car_order(make_passages(rows), ["event_id"], hot_rows, slice_seconds)
    got = {(r.car, r.pos): r.monitor_id for r in numbered.collect()}
    assert got == {(c or None, i + 1): m for c, t in tracks_by_hand(rows).items() for i, (m, _) in enumerate(t)}


def test_cars_per_range_in_parts(make_passages):
    rows = [(f"C{i:03d}", "m0", text(43200 + i % 300)) for i in range(250)]
    got = tracks.monitor_5min_cars(make_passages(rows), part_rows=20).orderBy("part").collect()
    assert [r.part for r in got] == list(range(13)) and max(r.cars.count("|") for r in got) == 19
    listed = "|".join(r.cars for r in got).split("|")
    assert listed == [f"{c}={t}" for c, _, t in sorted(rows, key=lambda r: (r[2], r[0]))]


def flow_by_hand(rows, flow):
    total = [0] * len(flow)
    for track in tracks_by_hand(rows).values():
        seen = [m for m, _ in track]
        for i in range(1, len(flow) + 1):
            total[i - 1] += sum(seen[s : s + i] == flow[:i] for s in range(len(seen)))
    return total


@pytest.mark.parametrize("hot_rows", [100, 10**6])
@pytest.mark.parametrize("flow", [["m0", "m0", "m1"], ["m3", "m1", "m0", "m3"], ["m0"] * 70])
def test_flow_counts(make_passages, flow, hot_rows):
    rows = rows_with_hot_car() + [("HOT", "m0", text(170000 + i)) for i in range(80)]
    got = funnel.flow_prefix_counts(make_passages(rows), flow, ["event_id"], hot_rows).orderBy("step").collect()
    assert [r.cnt for r in got] == flow_by_hand(rows, flow)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ABCD"), st.sampled_from("xy"), st.integers(0, 1500)), min_size=1, max_size=40),
    st.sampled_from([60, 300]),
)
def test_companions(spark, make_passages, rows, gap):
    p = make_passages([(c, m, text(43200 + s)) for c, m, s in rows])
    wanted = spark.createDataFrame([("A",), ("B",)], "car string")
    got = {(r.wanted_car, r.car, r.monitor_id): r.n_passages for r in tracks.companions(p, wanted, gap).collect()}
    want = {}
    for w in "AB":
        for car, monitor, sec in rows:
            if car != w and any(c == w and m == monitor and abs(s - sec) <= gap for c, m, s in rows):
                want[w, car, monitor] = want.get((w, car, monitor), 0) + 1
    assert got == want


def test_companions_of_a_hot_car_stay_linear(spark, make_passages):
    """The hot car passes every second; the joined side still has three rows per bucket at most."""
    rows = [("HOT", "m0", text(i)) for i in range(1200)] + [("C1", "m0", text(i * 100)) for i in range(12)]
    wanted = spark.createDataFrame([("HOT",)], "car string")
    assert tracks.companions(make_passages(rows), wanted).first().n_passages == 12


def crowd():
    """Forty wanted cars and sixty others, most of them in a few buckets of one checkpoint; some rows lack a part."""
    rows = [(f"C{i % 100:02d}", "m0", text(i * 7 % 900)) for i in range(700)]
    rows += [("C07" if i % 2 else "C77", "m0", text(400)) for i in range(200)]
    rows += [(f"C{i * 3 % 100:02d}", f"m{i % 5}", text(i * 97 % 20000)) for i in range(300)]
    rows += [("C01", None, text(5)), ("C80", None, text(6)), (None, "m0", text(7)), ("C01", "m0", "late"), ("C80", "m0", None)]
    return rows


@pytest.mark.parametrize("pair_rows", [50, 1000, 10**6])
def test_companions_in_slices(spark, make_passages, pair_rows):
    """The same results whether the pairs are dealt to slices of a bucket, to tasks, or not at all."""
    rows = crowd()
    wanted = spark.createDataFrame([(f"C{i:02d}",) for i in range(40)] + [("C03",), (None,)], "car string")
    found = tracks.companions(make_passages(rows), wanted, pair_rows=pair_rows).collect()
    got = {(r.wanted_car, r.car, r.monitor_id): r.n_passages for r in found}
    times = {}
    for car, monitor, time in rows:
        if car and monitor and time and time[0] == "2":
            h, m, s = map(int, time.split(" ")[1].split(":"))
            times.setdefault((monitor, car), []).append(h * 3600 + m * 60 + s)
    want = {}
    for (monitor, car), secs in times.items():
        for (at, w), seen in times.items():
            if at == monitor and w != car and w < "C40":
                n = sum(any(abs(t - s) <= 300 for s in seen) for t in secs)
                want.update({(w, car, monitor): n} if n else {})
    assert got == want and len(found) == len(want) > 4000


def test_a_task_holds_a_bounded_number_of_pairs(spark, make_passages):
    """The fullest task of the join has few times pair_rows pairs, though all pairs are in one bucket."""
    from pyspark.sql import types as T

    rows = [(f"C{i:03d}", "m0", text(i % 250)) for i in range(400)]
    wanted = spark.createDataFrame([(f"C{i:03d}",) for i in range(200)], "car string")
    pair_rows, seen, met = 2000, [], tracks._met

    def counted(reached, near, keys):
        pairs = met(reached, near, keys)
        seen.append(pairs.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return pairs

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tracks, "_met", counted)
        found = tracks.companions(make_passages(rows), wanted, pair_rows=pair_rows)
    assert found.count() == 200 * 399 and seen[0] <= 4 * pair_rows
    assert found.schema["n_passages"].dataType == T.LongType()


def test_sample_of_an_hour_with_most_cars(make_passages):
    rows = [(f"C{i:04d}", "m", text(28800 + i % 3600)) for i in range(2000)]
    rows += [(f"C{i:04d}", "m", text(36000 + i)) for i in range(100)]
    p = make_passages(rows)
    drawn = [r for r in sampling.sample_cars(p, 500, seed=1).collect()]
    quota = {r.hour: r.quota for r in sampling.sample_quota(p, 500).collect()}
    assert {h: sum(r.hour == h for r in drawn) for h in quota} == quota == {"08": 476, "10": 23}
    assert len({(r.hour, r.car) for r in drawn}) == len(drawn)
    assert {(r.hour, r.car) for r in drawn} == {(r.hour, r.car) for r in sampling.sample_cars(p, 500, seed=1).collect()}
    assert {(r.hour, r.car) for r in drawn} != {(r.hour, r.car) for r in sampling.sample_cars(p, 500, seed=2).collect()}


@pytest.mark.parametrize("salts", [1, 3, 50])
def test_salted_flow_is_the_same(spark, make_passages, salts):
    p = make_passages([("C", f"{i % 4}", text(i), "0", "1", "1" if i % 3 else "2", "01") for i in range(300)])
    dims = spark.createDataFrame([("01", "N")], "area_id string, area_name string")
    plain = sorted(map(tuple, areas.area_road_flow(p, dims).collect()))
    assert sorted(map(tuple, areas.area_road_flow_salted(p, dims, salts).collect())) == plain


def test_lists_by_another_key(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    got = ordered_lists(
        df, ["k"], ["id"], F.floor(F.col("id") / 7), F.col("id").cast("string"), ",", "ids", hot_rows=8, part_rows=8
    ).collect()
    for k in range(3):
        parts = [r.ids for r in sorted(got, key=lambda r: r.part) if r.k == k]
        assert ",".join(parts) == ",".join(str(i) for i in range(k, 100, 3)) and len(parts) == 5


def test_a_hot_null_key_is_split_too(spark, make_passages):
    p = make_passages([(None, "m", text(i)) for i in range(30)] + [("C1", "m", text(i)) for i in range(5)])
    got = sorted((r.car or "", r.part, r.track.count("m")) for r in tracks.car_track(p, hot_rows=10, part_rows=10).collect())
    assert got == [("", 0, 10), ("", 1, 10), ("", 2, 10), ("C1", 0, 5)]
    numbered = number_within(p, ["car"], ["event_id"], F.floor(F.col("event_id") / 4), 10)
    assert sorted(r.pos for r in numbered.where("car IS NULL").collect()) == list(range(1, 31))
