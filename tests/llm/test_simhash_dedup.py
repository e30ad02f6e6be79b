"""Fingerprints and components against brute force."""

import random

import numpy as np
import xxhash

from roadlens.llm import simhash_dedup as sd


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0


def plain_components(rows):
    """doc_id -> (hex, smallest doc_id reachable), all pairs compared."""
    prints = [(i, plain_print(t)) for i, t in rows]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return sorted((i if i is not None else -1, f"{p:016x}", least.get(find(p))) for i, p in prints)


def result(df):
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in sd.near_duplicates(df).collect())


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert result(docs) == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_copies(docs_of):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(500)}" for _ in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randrange(12)):
            words[rnd.randrange(200)] = f"v{rnd.randrange(9)}"
        rows.append((1000 - i, " ".join(words)))
    want = plain_components(rows)
    assert result(docs_of(rows)) == want
    assert 1 < len({w[2] for w in want}) < 120


def test_every_near_pair_shares_a_key():
    rnd = random.Random(1)
    for errors in (1, 2, 3):
        for _ in range(1500):
            a = rnd.getrandbits(64)
            b = a
            for bit in rnd.sample(range(64), errors):
                b ^= 1 << bit
            row, key = sd.keys(np.array([a, b], dtype=np.uint64))
            assert set(key[row == 0]) & set(key[row == 1])


def test_a_segment_has_one_or_six_keys_within_distance_four():
    v = np.arange(0, 1 << 23, 977, dtype=np.int64)
    keys, mask = sd.golay_keys(v)
    assert set(mask.sum(axis=1)) == {1, 6}


def test_odd_rows(odd, none):
    from conftest import ODD

    assert result(odd) == plain_components(ODD)
    assert sd.near_duplicates(none).count() == 0


def test_chain_of_links_is_one_component(spark, tmp_path):
    from roadlens.llm.shared import Kept

    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in sd.components(edges, Kept(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_a_large_set_under_one_key_is_cut_and_keeps_its_links(monkeypatch):
    rng = np.random.default_rng(3)
    near = [rng.integers(0, 2**63, dtype=np.uint64) for _ in range(40)]
    fp = {int(c) for c in near}
    for _ in range(900):
        c = int(rng.choice(list(fp)))
        for bit in rng.choice(64, size=rng.integers(1, 5), replace=False):
            c ^= 1 << int(bit)
        fp.add(c)
    fp = np.array(sorted(fp), dtype=np.uint64)

    def parts(a, b):
        root = {int(x): int(x) for x in fp}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            assert (x ^ y).bit_count() <= 3
            root[find(x)] = find(y)
        groups = {}
        for x in root:
            groups.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    whole = parts(*sd.forest(fp))
    monkeypatch.setattr(sd, "LARGE", 10)
    assert parts(*sd.forest(fp)) == whole and 1 < len(whole) < len(fp)
