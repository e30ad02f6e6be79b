"""Near-duplicates by SimHash, found with fuzzy hashing on the binary Golay code.

Fingerprints that differ in at most three of 64 bits are linked. The bits are cut into three segments of at most 23.
The perfect Golay code [23, 12] puts every segment within distance 3 of one codeword; a segment's keys are the
codewords within distance 4 of it, which are one or six, and two segments that differ in one bit share a key. Three
errors leave two segments with at most one error each, so by the pigeonhole principle two linked fingerprints share
either one exact segment and a key of another segment, or (one error in every segment) a key of each of the first two.

Copies have one fingerprint and go as one. Fingerprints meet by key; those that meet are verified, and a key gives a
spanning forest of the links among its fingerprints instead of all pairs. Joins in rounds then give each fingerprint
the smallest one it is connected with. A key holds distinct fingerprints only: those of a group of near copies lie
within a few bits, so their number is bounded by the geometry and not by the copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept, chunks, utf8

BITS_APART = 3
SHINGLE = 3
#: Sets of more fingerprints under one key are cut once more before they are compared.
LARGE = 2048
# The generator polynomial of the code, and where the segments begin and how long they are.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One 64-bit fingerprint a text: a bit is set if it is in over half the hashes of its shingles."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = text.lower().split()  # of bytes: only A-Z change, and white space is the space and \t to \r
        line = b" ".join(words)
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        if len(words) <= SHINGLE:
            found = [digest(line, 42)] if words else []
        else:
            starts = [0, *[e + 1 for e in ends[: len(words) - SHINGLE]]]
            found = [digest(line[s:e], 42) for s, e in zip(starts, ends[SHINGLE - 1 :])]
        hashes += found
        counts.append(len(found))
    n = np.array(counts, dtype=np.int64)
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        every = np.array(hashes, dtype=np.uint64)
        first = (np.cumsum(n) - n)[some]
        for bit in range(64):
            ones = np.add.reduceat((every >> np.uint64(bit)) & np.uint64(1), first)
            out[some] |= (2 * ones.astype(np.int64) > n[some]).astype(np.uint64) << np.uint64(bit)
    return out


@cache
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and high bits, the error of each syndrome, and the words that lead to five more keys."""

    def remainder(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    one = np.array([remainder(1 << i) for i in range(23)], dtype=np.int64)

    def table(bits: range) -> np.ndarray:
        t = np.zeros(1 << len(bits), dtype=np.int64)
        for i, b in enumerate(bits):
            t[1 << i : 2 << i] = t[: 1 << i] ^ one[b]
        return t

    low, high = table(range(12)), table(range(12, 23))
    error = np.zeros(2048, dtype=np.int64)
    weight3 = []
    for a in range(23):
        error[one[a]] = 1 << a
        for b in range(a):
            error[one[a] ^ one[b]] = 1 << a | 1 << b
            for c in range(b):
                s = one[a] ^ one[b] ^ one[c]
                error[s] = 1 << a | 1 << b | 1 << c
                weight3.append(s)
    every = np.arange(1 << 12, dtype=np.int64)
    words = every << 11
    words = words ^ low[words & 4095] ^ high[words >> 12]
    seven = words[np.bitwise_count(words) == 7]
    more = np.zeros((2048, 5), dtype=np.int64)
    for s in weight3:
        more[s] = seven[(seven & error[s]) == error[s]]
    return low, high, error, more


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (12 bits) of 23-bit values, as an n x 6 table and a mask of those that count: the first, or all six."""
    low, high, error, more = _code()
    s = low[segment & 4095] ^ high[segment >> 12]
    e = error[s]
    word = segment ^ e
    keys = np.concatenate([word[:, None], word[:, None] ^ more[s]], axis=1) >> 11
    mask = np.repeat((np.bitwise_count(e) == 3)[:, None], 6, axis=1)
    mask[:, 0] = True
    return keys, mask


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of fingerprints: index of the fingerprint, key. The top bits of a key name its kind."""
    parts = [((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    golay = [golay_keys(p) for p in parts]
    rows, out = [], []

    def add(kind: int, values: np.ndarray, mask: np.ndarray) -> None:
        row, column = np.nonzero(mask)
        rows.append(row)
        out.append(values[row, column] | np.int64(kind) << np.int64(40))

    for i, exact in enumerate(parts):
        for j, (k, mask) in enumerate(golay):
            if i != j:
                add(3 * i + j, exact[:, None] << 12 | k, mask)
    (a, am), (b, bm) = golay[:2]
    both = (a[:, :, None] << 12 | b[:, None, :]).reshape(len(fp), 36)
    add(9, both, (am[:, :, None] & bm[:, None, :]).reshape(len(fp), 36))
    return np.concatenate(rows), np.concatenate(out)


def forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what is linked in a set of distinct fingerprints.

    A large set is cut once more: of four blocks of 16 bits, two linked fingerprints have one in common, so the sets of
    one value of one block hold all links between them.
    """
    if len(fp) <= LARGE:
        return _forest(fp)
    found = [_forest(fp[:0])]
    for at in range(0, 64, 16):
        block = ((fp >> np.uint64(at)) & np.uint64(0xFFFF)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        for part in np.split(fp[order], np.flatnonzero(np.diff(block[order])) + 1):
            if len(part) > 1:
                found.append(_forest(part))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the connected parts, by comparing what is not yet connected with what is."""
    a, b = [], []
    left = fp
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            v = queue.pop()
            near = np.bitwise_count(left ^ v) <= BITS_APART
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(np.full(len(found), v))
                b.append(found)
                queue.extend(found)
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fp = batch.column("fp").slice(at, 4096).to_numpy().view(np.uint64)
            row, key = keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row].view(np.int64))], ["key", "fp"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal keys; a run may go on in the next batch."""
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.diff(key)) + 1
        start, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        size = end - start
        two = start[size == 2]
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= BITS_APART
        a, b = [fp[two][near]], [fp[two + 1][near]]
        for s, e in zip(start[size > 2], end[size > 2]):
            x, y = forest(fp[s:e])
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    for batch in batches:
        key = np.concatenate([held_key, batch.column("key").to_numpy()])
        fp = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            yield links(key[:cut], fp[:cut])
        held_key, held = key[cut:], fp[cut:]
    if len(held):
        yield links(held_key, held)


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, that connect what is linked among distinct fingerprints (column fp)."""
    met = distinct.select("fp").mapInArrow(_expanded, "key long, fp long").repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(_linked, "a long, b long").distinct()


def components(edges: DataFrame, kept: Kept) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node it is connected with.

    Rounds of large and small stars: neighbours hang themselves on the smallest neighbour, first the larger ones, then
    the smaller ones, until nothing changes. Minima combine before the shuffle; no list of neighbours is made.
    """
    state, before = kept.keep(edges, "edges-0"), None
    for i in count(1):
        both = state.union(state.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        hung = large.join(low, "b").select(F.col("a").alias("x"), "m").union(low.select(F.col("b").alias("x"), "m"))
        new = hung.where("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()
        state = kept.keep(new, f"edges-{i}")
        kept.drop(f"edges-{i - 1}")
        sign = tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if sign == before:
            break
        before = sign
    return state.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def fingerprinted(documents: DataFrame) -> DataFrame:
    """doc_id and fp (as a signed long) of every row; null, empty and blank texts have the fingerprint zero."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            fp = fingerprints(utf8(batch)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(made, f"doc_id {kind}, fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable by links) of every row.

    Null, empty and blank texts have the fingerprint zero and are linked like others; repeated rows give repeated
    results; a null doc_id is never a component's id, unless all its rows lack one; empty tables give no rows; further
    columns are not read.
    """
    kept = Kept(documents.sparkSession, "simhash")
    prints = kept.keep(fingerprinted(documents), "fingerprints")
    distinct = kept.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct), kept)
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = kept.keep(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = kept.keep(rooted.join(ids, "root").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
