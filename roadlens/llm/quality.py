"""Quality: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and digits or runs of other visible characters; a feature is the hash of one token or of two
in a row, with the value log(1 + count), and a text's features have length one. The FTRL-proximal updates run over a
bounded sample of labelled rows (``max_rows``); L1 leaves a sparse model, and a score is a sparse dot product. Every
whole text is scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import CHUNK_BYTES, Kept, chunks, in_fold, labelled_sample, utf8
from roadlens.llm.words import Hashes, cut

BITS = 20
MAX_ROWS = 3000

# per byte: 0 white space, 1 letters, digits and all of UTF-8 beyond ASCII, 2 other characters
_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens start and end."""
    kind = _KIND[data]
    change = np.flatnonzero(np.diff(kind)) + 1
    edges = np.concatenate([[0], change, [len(data)]]).astype(np.int64)
    visible = kind[edges[:-1]] > 0 if len(data) else np.zeros(1, dtype=bool)
    return edges[:-1][visible], edges[1:][visible]


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its distinct features: index of the text, index of the feature, value."""
    joined = b"\n".join(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    hashes, owners, at = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0
    for _, part, _ in cut(joined, 2 * CHUNK_BYTES):  # at white space, which parts tokens
        data = np.frombuffer(part, dtype=np.uint8)
        starts, ends = _tokens(data)
        hashes.append(Hashes(data, 3).of(starts, ends))
        owners.append(np.searchsorted(begins, starts + at, side="right") - 1)
        at += len(part)
    h, text_of = np.concatenate(hashes), np.concatenate(owners)
    if not len(h):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    inside = text_of[:-1] == text_of[1:]
    shift = np.uint64(64 - bits)
    one = (text_of.astype(np.uint64) << np.uint64(bits)) | (h >> shift)
    two = (text_of[:-1].astype(np.uint64) << np.uint64(bits)) | ((pair * np.uint64(0xC4CEB9FE1A85EC53)) >> shift)
    keys, counts = np.unique(np.concatenate([one, two[inside]]), return_counts=True)
    row = (keys >> np.uint64(bits)).astype(np.int64)
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(texts)))
    return row, (keys & np.uint64((1 << bits) - 1)).astype(np.int64), value / norm[row]


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, alpha: float = 0.5, beta: float = 1.0,
    l1: float = 0.3, l2: float = 0.5, epochs: int = 3, balance: float = 4.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-proximal updates over rows (features, values, label), in the order given.

    Rows of the rarer label weigh up to ``balance`` times as much.
    """
    ones = sum(label for _, _, label in rows)
    zeros = len(rows) - ones
    weight = [min(balance, max(1.0, other / max(own, 1))) for own, other in ((zeros, ones), (ones, zeros))]
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for index, value, label in rows:
            i, x = np.append(index, 1 << bits), np.append(value, 1.0)
            w = weights(i)
            g = weight[label] * (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange((1 << bits) + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        row, index, value = features(utf8(batch))
        cut = np.searchsorted(row, np.arange(1, batch.num_rows))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p.astype(np.int32) for p in np.split(index, cut)], pa.list_(pa.int32())),
                pa.array([p.astype(np.float32) for p in np.split(value, cut)], pa.list_(pa.float32())),
                batch.column("label"),
            ],
            ["i", "x", "label"],
        )


def train(documents: DataFrame, labels: DataFrame, fold=None, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Fit on at most ``max_rows`` rows that have a label in ``quality``, of those outside the held-out fold.

    The rows come in the order of a hash of their features. Without rows every score is 0.5.
    """
    usable = F.lit(True) if fold is None else ~fold
    kept = Kept(documents.sparkSession, "quality")
    sample = kept.keep(labelled_sample(documents, labels, "quality", usable, max_rows), "sample")
    found = sample.mapInArrow(_featured, "i array<int>, x array<float>, label int").toPandas()
    rows = [(np.array(i, dtype=np.int64), np.array(x, dtype=float), y) for i, x, y in found.itertuples(index=False)]
    kept.drop("sample")
    rows.sort(key=lambda r: (int(r[0].sum()) * 2654435761 % 2**32, len(r[0]), r[2]))
    return ftrl(rows)


def score(documents: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    weights, bias = model
    used = np.flatnonzero(weights)
    kept = weights[used]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(1 << BITS, dtype=np.float32)
        full[used] = kept
        for batch in chunks(batches):
            row, index, value = features(utf8(batch))
            z = np.bincount(row, weights=value * full[index], minlength=batch.num_rows) + bias
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s)], ["doc_id", "held_out", "score"])

    rows = documents.select("doc_id", in_fold(3, 1).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents``.

    Null and empty texts get the score of the bias alone; a null doc_id is never held out and never a training row;
    repeated rows give repeated results; empty tables give no rows; further columns are not read.
    """
    return score(documents, train(documents, labels, in_fold(3, 1)))
