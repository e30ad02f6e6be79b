"""Top-k against plain inner products."""

import math
import random

from roadlens.llm import topk_search as tk


def plain(rows, queries, k):
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and fine(v)]
    out = []
    for q, v in [(i, v) for i, v in whole if i in queries]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    asked = {i for i, _ in rows if i % 100 == 0}
    got = sorted(tuple(r) for r in tk.top_k(table.repartition(3), table.where("vec_id % 100 = 0")).collect())
    assert got == plain(rows, asked, 10)


def test_ties_odd_vectors_and_few_rows(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, 3.0]) for _ in range(3)]) for i in range(200)]
    rows += [(900, None), (901, [0.1, None, 0.2]), (902, [float("nan"), 1.0, 1.0]), (903, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (904, [1.0]), (905, [0.0, -0.0, 5.0, 7.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, score long, slot string").repartition(3)
    ids = [0, 7, 900, 904, 905]
    got = sorted(tuple(r) for r in tk.top_k(table, table.where(table.vec_id.isin(ids))).collect())
    assert got == plain(rows, ids, 10)
    few = table.where("vec_id < 4")
    got = sorted(tuple(r) for r in tk.top_k(few, few).collect())
    assert got == plain(rows[:4], [0, 1, 2, 3], 10)
    none = table.where("vec_id < -1")
    assert tk.top_k(none, none).count() == 0
    assert tk.top_k(table, none).count() == 0


def test_large_components_take_part(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(4)]) for i in range(300)]
    rows += [(400, [20000.0, 1.0, -3.0, 0.5]), (401, [-1e6, 1e6, 0.25, 7.0]), (402, [1e6, 1e6, 1e6, -1e6]), (403, [-20000.0, 0.0, 0.0, 1.0])]
    rows += [(404, [2.0**20, -1.0, 0.0, 0.0]), (405, [0.0, 0.0, 0.0, 0.0, 1.5 * 2.0**52]), (406, [0.0, 0.0, 0.0, 0.0, 1 / 1024])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ids = [0, 7, 100, 400, 401, 402, 403, 406]
    got = sorted(tuple(r) for r in tk.top_k(table, table.where(table.vec_id.isin(ids))).collect())
    assert got == plain(rows, ids, 10)
    assert {400, 401, 402, 404, 405} <= {r[2] for r in got}


def test_what_is_beyond_a_long_is_clipped_and_ranked_by_its_value(spark):
    rows = [(1, [1e12, 1.0]), (2, [1e12, 2.0]), (3, [1e30, 1.0]), (4, [-1e300, 1.0]), (5, [1.7e308, -3.0]), (6, [0.5, 1.0]), (7, [1e16, 0.1]), (8, []), (9, [2.0**63, 0.0])]
    some = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in tk.top_k(some, some).collect())
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    exact = [(i, [int(x) * 1024 if abs(x) >= 2.0**53 else math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q, v in exact:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in exact if i != q)
        want += [(q, r + 1, i, clip(-s)) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)


def test_empty_vectors_take_part_with_score_zero(spark):
    none = spark.createDataFrame([(1, []), (2, []), (100, [])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in tk.top_k(none, none.where("vec_id = 100")).collect()) == [(100, 1, 1, 0), (100, 2, 2, 0)]
    rows = [(1, []), (2, [1.0, -1.0]), (3, [-1.0]), (100, []), (200, [1.0])]
    some = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = sorted(tuple(r) for r in tk.top_k(some, some.where("vec_id >= 100")).collect())
    assert got == plain(rows, [100, 200], 10)
