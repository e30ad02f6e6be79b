"""Exact top-k by inner product on a bit-sliced index.

Vectors are quantised to whole numbers. The index holds blocks of rows; of every component and every bit a block has
one slice, a bitmap over its rows. A query's score is a sum of slices, each weighted by a power of two: carry-save
adders on whole bitmaps add them up into slices of the score, for a block of queries at once. A negative component takes
the complement of the slices, so that all terms are positive and only a constant is off. From the most significant
slice of the score downward, rows are kept or dropped until k are left; those equal at the boundary go by vec_id.

Slices are as many as the values of their block need, and the sums of slices have no upper end, so large components
only widen their own blocks. Vectors with a component beyond 62 bits have blocks of their own, without slices, and are
scored in whole numbers of any size. A score beyond a long is given as the nearest long and ranked by its true value.

Blocks of rows and of queries meet on a grid by key, so a task holds one block of each. All rows and all given queries
take part; the work is their product, and the index is copied once per ``PART`` queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept

K = 10
ROWS = 4096
#: Queries that meet a block in one task, and of them those scored at once.
PART = 1024
QUERIES = 128
#: Scores are longs.
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
#: More bits than any sum of products of two finite doubles has, for the order of scores beyond a long.
_BEYOND = 2400
_INDEX = "rows int, low long, width int, size int, ids binary, slices binary"
#: The width of a block that holds vectors as they are.
_WHOLE = -1


def quantised(vector: np.ndarray, scale: int = 1024) -> np.ndarray:
    """floor(scale * x) of every component: longs, or whole numbers of any size where a long might not do."""
    scaled = vector * scale
    if not (np.abs(vector) >= 2.0**62 / scale).any():
        return np.floor(scaled).astype(np.int64)
    # from 2^53 on a double is a whole number, and scaling it might leave the range of doubles
    return np.array([int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in vector.tolist()], dtype=object)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def _padded(vectors: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def slices_of(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Least value, bits, and the slices (component, bit, word of 64 rows) of a rows x components table."""
    low = int(values.min()) if values.size else 0
    shifted = (values - np.int64(low)).view(np.uint64).T  # the difference is below 2^64
    width = max(1, int(shifted.max() if values.size else 0).bit_length())
    bits = np.zeros((shifted.shape[0], width, -(-values.shape[0] // 64) * 64), dtype=np.uint8)
    for j in range(width):
        bits[:, j, : values.shape[0]] = (shifted >> np.uint64(j)) & np.uint64(1)
    return low, width, np.packbits(bits, axis=2, bitorder="little").view("<u8")


def _indexed(batches, scale: int):
    def block(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        rows = sorted(rows, key=lambda r: r[0])
        ids = np.array([i for i, _ in rows], dtype="<i8")
        size = max(len(v) for _, v in rows)
        low, width, slices = slices_of(_padded([v for _, v in rows], size))
        return packed(len(rows), low, width, size, ids.tobytes(), slices.tobytes())

    def packed(*row) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], [f.split()[0] for f in _INDEX.split(", ")])

    rows = []
    for batch in batches:
        for i, v in _vectors(batch):
            whole = quantised(v, scale)
            if whole.dtype == object:
                yield packed(1, 0, _WHOLE, len(v), np.array([i], dtype="<i8").tobytes(), v.astype("<f8").tobytes())
                continue
            rows.append((i, whole))
            if len(rows) == ROWS:
                yield block(rows)
                rows = []
    if rows:
        yield block(rows)


def _vectors(batch) -> list[tuple[int, np.ndarray]]:
    lists = batch.column("v").combine_chunks() if isinstance(batch, pa.Table) else batch.column("v")
    values, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())
    return list(zip(batch.column("vec_id").to_pylist(), np.split(values, ends[:-1]) if len(ends) else []))


class _Sum:
    """Bitmaps added up by weight; three of one weight become one and a carry."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, weight: int) -> None:
        while True:
            while len(self.waiting) <= weight:
                self.waiting.append([])
            here = self.waiting[weight]
            if len(here) < 2:
                here.append(bitmap)
                return
            a, b = here
            both = a ^ b
            here[:] = [both ^ bitmap]
            bitmap, weight = (a & b) | (both & bitmap), weight + 1

    def slices(self) -> list[np.ndarray]:
        """The sum, one bitmap per bit, from the least significant."""
        weight = 0
        while weight < len(self.waiting):
            here = self.waiting[weight]
            if len(here) == 2:
                a, b = here
                here[:] = [a ^ b]
                self.add(a & b, weight + 1)
            weight += 1
        return [w[0] if w else None for w in self.waiting]


def score_slices(slices: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """Slices (query, word) of the scores, but for a constant per query."""
    total, ones = _Sum(), np.uint64(2**64 - 1)
    size, width, _ = slices.shape
    magnitude = np.abs(queries[:, :size])
    flip = np.where(queries[:, :size] < 0, ones, np.uint64(0))
    for d in range(size):
        planes = [slices[d, j][None, :] ^ flip[:, d, None] for j in range(width)]
        for i in range(int(magnitude[:, d].max(initial=0)).bit_length()):
            mask = np.where(magnitude[:, d] >> i & 1, ones, np.uint64(0))[:, None]
            for j, plane in enumerate(planes):
                total.add(plane & mask, i + j)
    return total.slices()


def top_rows(sums: list[np.ndarray], some: np.ndarray, k: int) -> np.ndarray:
    """Bitmaps of at least k rows of ``some``: the k highest and what equals the last of them."""
    surely, maybe = np.zeros_like(some), some
    for s in reversed(sums):
        if s is None:
            continue
        upper = maybe & s
        n = np.bitwise_count(surely | upper).sum(axis=1, dtype=np.int64)[:, None]
        surely = np.where(n <= k, surely | upper, surely)
        maybe = np.where(n > k, upper, np.where(n == k, np.uint64(0), maybe & ~s))
    return surely | maybe


def _unsliced(block: dict) -> np.ndarray:
    """Components x rows of a sliced block."""
    n, size, width = block["rows"], block["size"], block["width"]
    slices = np.frombuffer(block["slices"], dtype="<u8").reshape(size, width, -(-n // 64))
    values = np.full((size, n), block["low"], dtype=np.int64)
    for j in range(width):
        bit = np.unpackbits(slices[:, j].copy().view(np.uint8), axis=1, bitorder="little")[:, :n] if size else values
        values += bit.astype(np.int64) << np.int64(j)  # may wrap on the way, never in the end
    return values


def _beyond(score: int) -> bytes | None:
    """What orders scores that are the same long: nothing, or their bytes."""
    return None if _LOW < score < _HIGH else (score + (1 << _BEYOND)).to_bytes(_BEYOND // 8 + 1, "big")


def _ranked(scores, ids: np.ndarray, k: int):
    """vec_id, score as a long, and what orders scores beyond it, of the k best of whole numbers of any size."""
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    best = [int(scores[i]) for i in order]
    clipped = np.array([min(max(x, _LOW), _HIGH) for x in best], dtype=np.int64)
    return ids[np.array(order, dtype=np.int64)], clipped, [_beyond(x) for x in best]


def _dot(a: np.ndarray, b: np.ndarray):
    """Sums of products in whole numbers of any size; the shorter vector goes on with zeros."""
    n = min(len(a), len(b))
    return a[:n].astype(object) @ b[:n].astype(object) if n else b[:0].astype(object).sum(axis=0)


def _best(block: dict, asked: list[tuple[int, np.ndarray]], k: int, scale: int):
    """query_id, vec_id, score and order of the best rows of one block for each query."""
    ids = np.frombuffer(block["ids"], dtype="<i8")
    if block["width"] == _WHOLE:
        values = quantised(np.frombuffer(block["slices"], dtype="<f8"), scale)[:, None]
    else:
        values = _unsliced(block)
    plain = [q for q in asked if q[1].dtype != object and block["width"] != _WHOLE]
    for at in range(0, len(plain), QUERIES):
        yield from _best_plain(block, values, ids, plain[at : at + QUERIES], k)
    for query_id, v in asked:
        if v.dtype == object or block["width"] == _WHOLE:
            others = ids != query_id
            yield query_id, *_ranked(np.asarray(_dot(v, values), dtype=object)[others], ids[others], k)


def _best_plain(block: dict, values: np.ndarray, ids: np.ndarray, asked: list[tuple[int, np.ndarray]], k: int):
    n, size, width = block["rows"], block["size"], block["width"]
    slices = np.frombuffer(block["slices"], dtype="<u8").reshape(size, width, -(-n // 64))
    ids_q, queries = np.array([i for i, _ in asked]), _padded([v[:size] for _, v in asked], size)
    others = ids[None, :] != ids_q[:, None]
    some = np.pad(others.astype(np.uint8), ((0, 0), (0, -n % 64)))
    some = np.packbits(some, axis=1, bitorder="little").view("<u8")
    found = np.unpackbits(top_rows(score_slices(slices, queries), some, k).view(np.uint8), axis=1, bitorder="little")
    # sums in floating point bound the scores; beyond 2^62 they are made of whole numbers of any size
    wide = np.abs(queries.astype(np.float64)) @ np.abs(values.astype(np.float64)).max(axis=1, initial=0) > 2.0**62
    for q in range(len(queries)):
        rows = np.flatnonzero(found[q])
        if wide[q]:
            yield ids_q[q], *_ranked(_dot(queries[q], values[:, rows]), ids[rows], k)
        else:
            scores = queries[q] @ values[:, rows]
            order = np.lexsort((ids[rows], -scores))[:k]
            yield ids_q[q], ids[rows[order]], scores[order].astype(np.int64), [None] * len(order)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = K, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows, ties by smaller vec_id.

    ``embeddings`` and ``queries`` have vec_id and embedding. Vectors that are null or hold null or non-finite
    components take no part, nor do rows without a vec_id; of two vectors of different length the shorter one
    goes on with zeros, so with an empty one every score is 0. A query never meets rows of its own vec_id. A vec_id that
    repeats among the rows counts as often as it is there, among the queries once (the smaller vector). A score beyond a
    long is the nearest long, but ranked by its true value. Empty tables give no rows; further columns are not read.
    """
    kept = Kept(embeddings.sparkSession, "topk")

    def vectors(df: DataFrame) -> DataFrame:
        known = df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        return known.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    index = kept.keep(vectors(embeddings).mapInArrow(lambda b: _indexed(b, scale), _INDEX), "index")
    asked = kept.keep(vectors(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    slots, parts = max(1, index.count()), max(1, -(-asked.count() // PART))
    slot = F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    rows = index.select("*", slot, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    wanted = asked.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(3)]
        beyond: list[bytes | None] = []
        if left.num_rows and right.num_rows:
            q = [(i, quantised(v, scale)) for i, v in _vectors(right)]
            for block in left.to_pylist():
                for query_id, ids, scores, order in _best(block, q, k, scale):
                    for column, x in zip(out, (np.full(len(ids), query_id), ids, scores)):
                        column.append(x)
                    beyond += order
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in out]
        return pa.table([*columns, pa.array(beyond, pa.binary())], names=["query_id", "vec_id", "score", "beyond"])

    cells = rows.groupBy("part", "slot").cogroup(wanted.groupBy("part", "slot"))
    found = cells.applyInArrow(searched, "query_id long, vec_id long, score long, beyond binary")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
