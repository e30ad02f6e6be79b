"""Witnesses against trees made level by level in plain Python."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from roadlens.llm import merkle_manifest as m
from roadlens.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, place int, path string"


def h(*digests):
    return sha256("".join(digests).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n = row[:5]
    values = [doc_id, source, lang, None if n is None else n + more, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    """(side, sibling) from the i-th leaf upwards."""
    steps = []
    for nodes in tree[:-1]:
        j = i ^ 1
        steps.append((0, None) if j >= len(nodes) else (j - i, nodes[j]))
        i >>= 1
    return steps


def fold(node, steps):
    for side, other in steps:
        node = h(other, node) if side < 0 else h(node, other) if side else h(node)
    return node


def expected(rows):
    """One tuple a row, in the query's columns."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = levels([leaf_of(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, j)
            wrong = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            root = fold(leaf_of(row, int(wrong)), steps)
            assert fold(leaf_of(row), steps) == top[-1][0]
            proof = h(*[s for _, s in steps if s])
            out.append((row[0], leaf_of(row), trees[g][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    sizes = {"en": 150, "de": 64, "fr": 65, None: 33, "": 1, "é": 2, "z": 8}
    made = [(i, f"text {i} " * rng.randrange(4), g, rng.choice(["a", None]), i % 5 or None) for i, g in enumerate(g for g, n in sizes.items() for _ in range(n))]
    made += [(7, None, "en", None, None), (7, "", "en", None, 0), (None, "x", "en", "s", 1), (None, None, None, None, None)]
    made += [(9, "again", "de", "s", 5)] * 40
    rng.shuffle(made)
    return [(*r, "clash", 1, "clash") for r in made]


@pytest.mark.parametrize("bits", [1, 2, 3, 10])
def test_witnesses(spark, rows, bits, monkeypatch, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    whole = m.witnessed
    monkeypatch.setattr(m, "witnessed", lambda *a, **k: whole(*a, bits=bits, **k))
    found = op13_merkle_manifest(spark, str(tmp_path))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_few_rows(spark, tmp_path, n):
    rows = [(i, "t", "en", "s", 1, "", 0, "") for i in range(n)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr) == expected(rows)


def test_one_group_spreads_over_blocks(spark):
    """A hot group is dealt out by blocks; a path is as long as the tree is high."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    found = m.witnessed(docs, m.leaf_digest(F.col("doc_id")), bits=4)
    sizes = {r.n for r in found.select(F.size("path").alias("n")).collect()}
    assert sizes == {13}
    assert found.where(m.folded(F.col("leaf"), F.col("path")) != m.hex_of(F.col("root"))).count() == 0


def test_empty(none):
    assert m.witnessed(none, m.leaf_digest(F.col("doc_id"))).collect() == []


def test_appended_nodes_extend_partial_witnesses():
    digests = [sha256(bytes([i])).digest() for i in range(11)]
    block = m.Block()
    for i, d in enumerate(digests):
        block.append(d)
        tree = levels([x.hex() for x in digests[: i + 1]])
        for j, steps in enumerate(block.paths):  # what is known is the start of the witness of the nodes so far
            known = [(s, o.hex()) for s, o in steps]
            assert known == path(tree, j)[: len(known)]
    assert block.close().hex() == tree[-1][0]
