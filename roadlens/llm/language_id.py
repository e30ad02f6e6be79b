"""Languages of a text as a mixture, whose proportions expectation-maximisation estimates from n-gram likelihoods.

Training counts character trigrams per language over all training documents, hashed to 2^16 cells, or fewer where there
are more than 64 languages, so the model has a fixed size whatever ``lang`` holds. A text is taken as drawn from a mixture of the languages; EM estimates the proportions, and
the set of languages is the one with the highest likelihood less a penalty per language. The language with the largest
proportion in that set is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import chunks, in_fold, texts

CELLS = 1 << 16
#: Numbers in a model: the cells of all languages.
MODEL = 1 << 22
PENALTY = 5.0
_FLUSH = 64


def cells(text: str) -> np.ndarray:
    """The cells of a text's trigrams; what is no letter counts as a space, trigrams of spaces don't count."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = (codes >= 128) | ((codes >= 97) & (codes <= 122))
    c = np.where(letter, codes, 32).astype(np.uint32)
    if len(c) < 3:
        c = np.concatenate([c, np.full(3 - len(c), 32, dtype=np.uint32)])
    a, b, d = c[:-2], c[1:-1], c[2:]
    h = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (d * np.uint32(0xC2B2AE35))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.uint16)[(a != 32) | (b != 32) | (d != 32)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of cells by language, added up in the task; many languages go out in several parts."""
    held: dict[str, np.ndarray] = {}

    def flush():
        for lang, n in held.items():
            cell = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cell), pa.string()), pa.array(cell.astype(np.int32)), pa.array(n[cell])],
                ["lang", "cell", "n"],
            )
        held.clear()

    for batch in chunks(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
            if lang not in held:
                if len(held) == _FLUSH:
                    yield from flush()
                held[lang] = np.zeros(CELLS, dtype=np.int64)
            held[lang] += np.bincount(cells(text), minlength=CELLS)
    yield from flush()


def train(documents: DataFrame, fold: Column | None = None, alpha: float = 0.01) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-likelihood of each cell under each. All rows with a lang outside the fold count."""
    usable = F.col("lang").isNotNull() & (F.lit(True) if fold is None else ~fold)
    rows = documents.where(usable).select("lang", "text")
    number, size = rows.agg(F.count_distinct("lang")).first()[0], CELLS
    while size > 1 and size * number > MODEL:
        size //= 2
    counts = rows.mapInArrow(_counted, "lang string, cell int, n long")
    cell = F.shiftright("cell", (CELLS // size).bit_length() - 1).alias("cell")
    table = counts.groupBy("lang", cell).agg(F.sum("n").alias("n")).toPandas()  # at most MODEL rows
    names = sorted(table["lang"].unique())
    n = np.full((len(names), size), alpha)
    np.add.at(n, (table["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(dtype=int), table["cell"].to_numpy()), table["n"])
    return names, np.log(n) - np.log(n.sum(axis=1, keepdims=True)) if names else n


def _mixture(likelihood: np.ndarray, counts: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood. likelihood: languages x distinct cells."""
    share = np.full(len(likelihood), 1 / len(likelihood))
    total = counts.sum()
    for _ in range(rounds):
        mixed = share @ likelihood
        new = share * (likelihood @ (counts / mixed)) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(counts @ np.log(share @ likelihood))


def languages(text: str, logs: np.ndarray, penalty: float = PENALTY) -> dict[int, float]:
    """The selected languages and their proportions: by proportion, languages join while the gain beats the penalty."""
    if not len(logs):
        return {}
    found = np.sort(cells(text) // np.uint32(CELLS // logs.shape[1]), kind="stable")
    if not len(found):
        return {}
    edge = np.flatnonzero(np.diff(found)) + 1
    distinct = found[np.concatenate([[0], edge])]
    counts = np.diff(np.concatenate([[0], edge, [len(found)]])).astype(float)
    local = logs[:, distinct]
    top = local.max(axis=0)
    likelihood = np.exp(local - top)
    alone = local @ counts
    best = int(alone.argmax())
    chosen, shares, value = [best], np.ones(1), float(alone[best] - top @ counts)
    if len(logs) == 1:
        return {best: 1.0}
    cost = penalty * np.log(counts.sum() + 1)
    order = [i for i in np.argsort(-_mixture(likelihood, counts)[0], kind="stable") if i != best]
    for i in order:
        tried = [*chosen, int(i)]
        share, v = _mixture(likelihood[tried], counts)
        if v - value <= cost:
            break
        chosen, shares, value = tried, share, v
    return {i: float(s) for i, s in zip(chosen, shares)}


def predict(documents: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = PENALTY) -> DataFrame:
    """doc_id, held_out, lang_pred, score (its proportion), and all selected languages with their proportions."""
    names, logs = model
    logs = logs.astype(np.float32)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            best, scores, mixtures = [], [], []
            for text in texts(batch):
                found = languages(text, logs, penalty) if any(map(str.isalpha, text)) else {}
                top = max(found, key=lambda i: (found[i], -i), default=None)
                best.append("und" if top is None else names[top])
                scores.append(0.0 if top is None else min(1.0, found[top]))
                mixtures.append(",".join(f"{names[i]}:{s:.3f}" for i, s in sorted(found.items())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(scores), pa.array(mixtures, pa.string())],
                ["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    rows = documents.select("doc_id", in_fold(3, 1).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages string")


def language(documents: DataFrame) -> DataFrame:
    """The predicted language of every row of ``documents``, learned from its rows outside the held-out fold.

    Null texts and texts without a letter are `und` with score 0, as is every text when no row has a lang. A null
    doc_id is never held out; repeated rows give repeated results; empty tables give no rows; other columns aren't read.
    """
    return predict(documents, train(documents, in_fold(3, 1)))
