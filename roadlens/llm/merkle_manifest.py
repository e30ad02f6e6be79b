"""A Merkle tree over the rows of a dataset, with a witness for every row, by aligned append.

The rows of a group (a language) are the leaves of its subtree, in order; the roots of the groups are the leaves of the
tree above. On each level two consecutive nodes become one, a last single one is hashed alone, until one node is left.

Leaves are dealt into aligned blocks of 2^``bits``, a subtree each. A block takes its leaves as a stream: an appended leaf
completes the open subtrees of its size, and each completion extends the witnesses of both sides by the other's root.
So a witness is partial until its block is closed. The roots of blocks are appended to blocks of their own, round by
round, until a group has one root; from there the rounds go back, and each block extends the witnesses of its members by
its own.

Rows are numbered without a global sort in one task: they are range-partitioned, numbered in each part, and the counts of
parts and groups, a few rows a part, give the offsets. A block is a bounded group, so a hot group is spread over as many
tasks as it has blocks. Texts are read once, for the leaves, and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept
from roadlens.operators.sizing import broadcast_if_small

BITS = 10
LEFT, ALONE, RIGHT = -1, 0, 1
_PATH = "array<struct<side: int, digest: binary>>"
_PATH_TYPE = pa.list_(pa.struct([("side", pa.int32()), ("digest", pa.binary())]))


def leaf_digest(*values: Column) -> Column:
    """sha256 (binary) of a row's values: of each its length in bytes, a colon and the text; a dash for null."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(written, values)), 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def combined(*digests: bytes) -> bytes:
    """sha256 of digests, which go in as hexadecimal text."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


class Block:
    """An aligned subtree that nodes are appended to. ``paths`` holds the witness of each node as far as it is known."""

    def __init__(self):
        self.open: list[tuple[bytes, int, int] | None] = []  # by level: digest, first and last + 1 node
        self.paths: list[list[tuple[int, bytes | None]]] = []

    def _joined(self, left: tuple[bytes, int, int], right: tuple[bytes, int, int]) -> tuple[bytes, int, int]:
        for i in range(left[1], left[2]):
            self.paths[i].append((RIGHT, right[0]))
        for i in range(right[1], right[2]):
            self.paths[i].append((LEFT, left[0]))
        return combined(left[0], right[0]), left[1], right[2]

    def append(self, digest: bytes) -> None:
        node = (digest, len(self.paths), len(self.paths) + 1)
        self.paths.append([])
        for level in count():
            if level == len(self.open):
                self.open.append(None)
            left = self.open[level]
            if left is None:
                self.open[level] = node
                return
            self.open[level], node = None, self._joined(left, node)

    def close(self, levels: int | None = None) -> bytes:
        """The root, after ``levels`` levels; without a number where one node is left."""
        node = None
        for level in count():
            left = self.open[level] if level < len(self.open) else None
            if left and node:
                node = self._joined(left, node)
                continue
            node = node or left
            if level == levels or levels is None and not any(self.open[level + 1 :]):
                return node[0]
            if node:  # the last of its level, without a neighbour
                for i in range(node[1], node[2]):
                    self.paths[i].append((ALONE, None))
                node = combined(node[0]), node[1], node[2]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their part and their place among the part's rows of their group."""
    part, group, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column("g")
        first = _starts(groups)
        size = np.diff(np.append(first, batch.num_rows))
        place = np.arange(batch.num_rows) - np.repeat(first, size)
        if groups[0].as_py() == group:
            place[: size[0]] += n
        group, n = groups[-1].as_py(), int(place[-1]) + 1
        parts = pa.array(np.full(batch.num_rows, part, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(place)], [*batch.schema.names, "part", "place"])


def _starts(*columns) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        codes = c.dictionary_encode()
        codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole blocks, and where these start; a block may come in several batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        first = _starts(table["g"], table["block"])
        if len(first) > 1:
            yield table.slice(0, first[-1]), first[:-1]
        held = table.slice(first[-1])
    if held is not None:
        yield held, np.zeros(1, dtype=np.int64)


def _closed(digests: Sequence[bytes], total: int, bits: int) -> tuple[Block, bytes]:
    """The block of these nodes, and its root; a group of more nodes than a block holds goes on above it."""
    block = Block()
    for d in digests:
        block.append(d)
    return block, block.close(bits if total > 1 << bits else None)


def _roots(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for table, first in _blocks(batches):
        digests, total = table["digest"].to_pylist(), table["total"].to_numpy()
        ends = np.append(first[1:], len(digests))
        roots = [_closed(digests[a:b], total[a], bits)[1] for a, b in zip(first, ends)]
        one = table.select(["g", "block"]).take(pa.array(first)).combine_chunks().to_batches()[0]
        above = pa.array((total[first] + (1 << bits) - 1) >> bits)
        yield pa.RecordBatch.from_arrays([*one.columns, above, pa.array(roots, pa.binary())], ["g", "place", "total", "digest"])


def _witnessed(batches: Iterator[pa.RecordBatch], bits: int, carried: list[str]) -> Iterator[pa.RecordBatch]:
    """Members of blocks with their whole path and the group's root; a block's own are in its first row."""
    for table, first in _blocks(batches):
        digests, total = table["digest"].to_pylist(), table["total"].fill_null(0).to_numpy()
        above, tops = table["path"].take(pa.array(first)).to_pylist(), table["top"].take(pa.array(first)).to_pylist()
        sides, others, size, top = [], [], [], []
        for a, b, path, root in zip(first, np.append(first[1:], len(digests)), above, tops):
            up = [(s["side"], s["digest"]) for s in path]
            for own in _closed(digests[a + 1 : b], total[a + 1], bits)[0].paths:
                own += up
                size.append(len(own))
                for side, other in own:
                    sides.append(side)
                    others.append(other)
            top += [root] * (b - a - 1)
        members = np.ones(table.num_rows, dtype=bool)
        members[first] = False
        rows = table.select(carried).filter(pa.array(members)).combine_chunks()
        if not rows.num_rows:
            continue
        steps = pa.StructArray.from_arrays([pa.array(sides, pa.int32()), pa.array(others, pa.binary())], fields=list(_PATH_TYPE.value_type))
        paths = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), steps)
        yield pa.RecordBatch.from_arrays([*rows.to_batches()[0].columns, paths, pa.array(top, pa.binary())], [*carried, "path", "top"])


def _tree(rows: DataFrame, kept: Kept, name: str, bits: int) -> DataFrame:
    """``rows`` (g, order, digest and more) with the path of each digest up to the root of its group, and that root."""
    order = ["g", "order", "digest", "tie"]
    # rows equal in all that counts may stand in any order, but not all in one part
    # written first, since ranges are made from a sample, which reads its input once more
    digests = kept.keep(rows.withColumn("tie", F.monotonically_increasing_id()), f"{name}-digests")
    ranged = digests.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    leaves = kept.keep(ranged.mapInArrow(_numbered, f"{schema}, part int, place long").drop("tie"), f"{name}-leaves")
    kept.drop(f"{name}-digests")
    counts = leaves.groupBy("g", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("g")).alias("total")
    )
    offsets = kept.keep(offsets, f"{name}-offsets")
    placed = leaves.join(broadcast_if_small(offsets), ["g", "part"])
    nodes = placed.withColumn("place", F.col("place") + F.col("before")).drop("part", "before")

    rounds = []
    for i in count():
        dealt = nodes.withColumn("block", F.shiftright("place", bits))
        rounds.append(dealt)
        streamed = dealt.select("g", "block", "place", "total", "digest").repartition("g", "block").sortWithinPartitions("g", "block", "place")
        found = streamed.mapInArrow(lambda b: _roots(b, bits), "g string, place long, total long, digest binary")
        nodes = kept.keep(found, f"{name}-{i}")
        if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
            break
    known = nodes.select("g", "place", F.array().cast(_PATH).alias("path"), F.col("digest").alias("top"))
    for i, dealt in reversed(list(enumerate(rounds))):
        carried = [c for c in dealt.columns if c not in ("total", "block")]
        heads = known.select("g", F.col("place").alias("block"), "path", "top")
        both = dealt.unionByName(heads, allowMissingColumns=True).repartition("g", "block")
        streamed = both.sortWithinPartitions("g", "block", F.asc_nulls_first("place"))
        schema = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in carried)
        known = streamed.mapInArrow(lambda b, c=carried: _witnessed(b, bits, c), f"{schema}, path {_PATH}, top binary")
        if i:
            known = kept.keep(known, f"{name}-paths-{i}")
    return known.drop("place")


def witnessed(
    documents: DataFrame, digest: Column, order: str = "doc_id", group: str = "lang", carry: Sequence[Column] = (), bits: int = BITS
) -> DataFrame:
    """Per row: the ``order`` column, ``leaf``, the carried columns, ``path``, ``subroot`` and ``root``.

    ``digest`` makes a row's leaf. Leaves stand by ``order`` in their group, null first, equal ones by their digest; groups
    stand by their bytes, null first. The path leads from the leaf to the root: the side and the digest of the neighbour
    on each level, with side 0 and null where there is none. Rows that repeat are leaves each; null and empty texts are
    values like others; one row in all is its own root, with an empty path; empty tables give no rows; columns that
    aren't named are not read.
    """
    kept = Kept(documents.sparkSession, "merkle")
    g = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("g")
    rows = documents.select(g, F.col(order).alias("order"), digest.alias("digest"), F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    below = kept.keep(_tree(rows, kept, "rows", bits), "rows")
    groups = below.groupBy("g").agg(F.first("top").alias("digest"))
    above = _tree(groups.select(F.lit("").alias("g"), F.col("g").alias("order"), "digest"), kept, "groups", bits)
    above = kept.keep(above.select(F.col("order").alias("g"), F.col("path").alias("up"), F.col("top").alias("root")), "groups")
    return below.join(broadcast_if_small(above, 10_000), "g").select(
        F.col("order").alias(order), F.col("digest").alias("leaf"), "carried.*", F.concat("path", "up").alias("path"),
        F.col("top").alias("subroot"), "root",
    ).drop("_")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to, as hexadecimal text."""

    def step(node: Column, at: Column) -> Column:
        other = hex_of(at["digest"])
        pair = F.when(at["side"] == LEFT, F.concat(other, node)).when(at["side"] == RIGHT, F.concat(node, other))
        return F.sha2(pair.otherwise(node), 256)

    return F.reduce(path, hex_of(leaf), step)


def proof_digest(path: Column) -> Column:
    """sha256 of the path's digests, from the leaf to the root."""
    others = F.filter(path, lambda at: at["side"] != ALONE)
    return F.sha2(F.array_join(F.transform(others, lambda at: hex_of(at["digest"])), ""), 256)
