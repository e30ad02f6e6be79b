"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A feature is a character n-gram's presence in the lower-cased text, times log(p / q), p and q being the smoothed shares
of toxic and other sample texts that hold it. Logistic regression on the scaled features gives the weights. The model
is fitted on a bounded sample of labelled rows (``max_rows``) and keeps ``max_features`` n-grams, so it is a few ten
kilobytes at any size; every whole text is scored, one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept, chunks, in_fold, labelled_sample, texts
from roadlens.llm.words import mixed

SIZES = (3, 4, 5)
MAX_ROWS = 5000
MAX_FEATURES = 4096
_FILTER_BITS = 22


def grams(text: str) -> np.ndarray:
    """64-bit hashes of the text's character n-grams, repeats included."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    found = []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(29))
        if n in SIZES:
            found.append(h)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


@dataclass(frozen=True)
class Model:
    """Sorted n-gram hashes, what each adds when present, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        """A function from text to score. A bit table leaves few n-grams to look up."""
        if not len(self.keys):
            base = _sigmoid(self.bias)
            return lambda text: base
        shift = np.uint64(64 - _FILTER_BITS)
        table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        table[mixed(self.keys) >> shift] = True

        def score(text: str) -> float:
            h = grams(text)
            h = np.unique(h[table[mixed(h) >> shift]])
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            return _sigmoid(self.bias + float(self.weights[at[self.keys[at] == h]].sum()))

        return score


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of a chunk with the texts of either label that hold it."""
    for batch in chunks(batches):
        labels = batch.column("label").to_pylist()
        found = [np.unique(grams(t)) for t in texts(batch)]
        keys, inverse = np.unique(np.concatenate(found), return_inverse=True)
        toxic = np.repeat(np.array(labels, dtype=np.int64), [len(f) for f in found])
        ones = np.bincount(inverse, weights=toxic, minlength=len(keys)).astype(np.int64)
        both = np.bincount(inverse, minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(both - ones), pa.array(ones)], ["h", "n0", "n1"])


def fit(
    sample: DataFrame, max_features: int = MAX_FEATURES, alpha: float = 1.0, l2: float = 5.0, balance: float = 3.0
) -> Model:
    """Fit on a sample of (text, label). Without rows the score is 0, with one label it is near that label.

    The rarer toxic rows weigh up to ``balance`` times as much.
    """
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 + n1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    prior = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    if not n0 or not n1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), prior)
    counts = sample.mapInArrow(_counted, "h long, n0 long, n1 long").groupBy("h").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    apart = F.abs(F.col("n1") / F.lit(n1) - F.col("n0") / F.lit(n0))
    chosen = counts.where(F.col("n0") + F.col("n1") >= 3).orderBy(apart.desc(), "h").limit(max_features).toPandas()
    if chosen.empty:
        return Model(np.zeros(0, np.uint64), np.zeros(0), prior)
    chosen["key"] = chosen["h"].to_numpy().view(np.uint64)
    chosen = chosen.sort_values("key")
    keys = chosen["key"].to_numpy()
    p, q = chosen["n1"].to_numpy() + alpha, chosen["n0"].to_numpy() + alpha
    ratio = np.log((p / (n1 + 2 * alpha)) / (q / (n0 + 2 * alpha)))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text in texts(batch):
                h = np.unique(grams(text))
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                rows.append(at[keys[at] == h].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), batch.column("label")], ["f", "label"])

    # at most max_rows lists of at most max_features numbers
    rows = sample.mapInArrow(present, "f array<int>, label int").toPandas()
    # sums in floating point depend on the order of the rows, and that on the partitions
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (int(rows["label"][i]), list(rows["f"][i])))].reset_index(drop=True)
    y = rows["label"].to_numpy().astype(float)
    row = np.repeat(np.arange(len(rows)), rows["f"].map(len))
    column = np.concatenate(rows["f"].to_list()).astype(np.int64)
    w, bias = _logistic(row, column, ratio, y, np.where(y == 1, np.clip(n0 / n1, 1, balance), 1.0), l2)
    return Model(keys, w * ratio, bias)


def _logistic(row, column, ratio, y, weight, l2: float, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of the regularised logistic loss, by gradient steps with Adam's scaling."""
    n, scaled = len(y), ratio[column]
    x = np.zeros(len(ratio) + 1)
    x[-1] = np.log((weight @ y + 0.5) / (weight @ (1 - y) + 0.5))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=scaled * x[column], minlength=n) + x[-1]
        d = weight * (_sigmoid(z) - y)
        g = np.append(np.bincount(column, weights=scaled * d[row], minlength=len(ratio)) + l2 * x[:-1], d.sum()) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x[:-1], float(x[-1])


def score(documents: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of every whole text as column ``name``; all other columns stay. Null texts count as empty."""

    @F.pandas_udf("double")
    def scored(column):
        one = model.scorer()
        return column.fillna("").map(one).astype(float)

    return documents.withColumn(name, scored(F.col(text)))


def train(documents: DataFrame, labels: DataFrame, fold: Column | None = None, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` rows that have a label in ``toxic``, of those outside the held-out fold."""
    usable = F.lit(True) if fold is None else ~fold
    kept = Kept(documents.sparkSession, "toxicity")  # the sample is read three times, the documents once
    model = fit(kept.keep(labelled_sample(documents, labels, "toxic", usable, max_rows), "sample"))
    kept.drop("sample")
    return model


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents``.

    Null and empty texts get the score of a text without n-grams; a null doc_id is never held out and never a training
    row; repeated rows give repeated results; empty tables give no rows; further columns are not read.
    """
    fold = in_fold(5, 0)
    scored = score(documents.select("doc_id", "text"), train(documents, labels, fold))
    return scored.select(
        "doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
