"""Removal of repeated passages by compacting a De Bruijn graph of the corpus.

An edge of the graph is a window of ``WINDOW`` words, a node what two neighbouring windows share. Windows that occur
once are of no use, so candidates come first: every window has a minimizer, its first shingle of ``SHINGLE`` words with
the smallest hash; windows in a row with one minimizer are a run, and only runs whose minimizer is in another run as
well can hold repeated windows. Their windows are counted by a digest of 128 bits of their words.

A path is nonbranching where all occurrences of a window go on with one word, all of the next window come from one
word, and both are as many. As all occurrences of a path run side by side, its windows lie side by side where they
occur first; so a path is a run of first coordinates in one document. Only the ends of paths then meet their
occurrences in a join, and coordinates verify each span: head and tail have to lie as far apart as the path is long.
Every occurrence but the first is removed.

Equal texts enter the graph once: all windows of a copy start earlier in the copy with the smallest doc_id, so a group
of copies costs a digest per row, however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.shared import CHUNK_BYTES, Kept, chunks, utf8
from roadlens.llm.words import Hashes, Words, cut, digests

WINDOW = 20
SHINGLE = 6
_RUN = "m long, doc_id {}, start int, n int"
_EDGE = "h long, g long, doc_id {}, start int, before long, after long"


def _minimizers(h: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value, and where it is first, of each ``span`` values in a row."""
    value, at, width = h, np.arange(len(h)), 1
    while width < span:
        step = min(width, span - width)
        right = value[step:] < value[: len(value) - step]
        at = np.where(right, at[step:], at[: len(at) - step])
        value = np.where(right, value[step:], value[: len(value) - step])
        width += step
    return value, at


def _parts(batch: pa.RecordBatch, overlap: int) -> Iterator[tuple[Words, int, bool, bool]]:
    """The words of a chunk, or of a part of its one long text: with the words before it, and if it is the first, the last."""
    texts = utf8(batch)
    if len(texts) > 1 or len(texts[0]) <= CHUNK_BYTES:
        yield Words(texts), 0, True, True
        return
    for before, part, last in cut(texts[0], CHUNK_BYTES, overlap):
        yield Words([part]), before, before == 0, last


def _runs(batches: Iterator[pa.RecordBatch], window: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Windows in a row with one minimizer: its hash, the document, the first window, their number."""
    for batch in chunks(batches):
        for w, before, _, _ in _parts(batch, window - 1):
            first = w.windows(window)
            if not len(first):
                continue
            at = np.arange(len(w.starts) - shingle + 1)
            h = Hashes(w.data, 1).of(w.starts[at], w.ends[at + shingle - 1])
            value, where = _minimizers(h, window - shingle + 1)
            value, where = value[first], where[first]
            new = np.ones(len(first), dtype=bool)
            new[1:] = (where[1:] != where[:-1]) | (np.diff(first) != 1)
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(first)))
            word = first[begin]
            doc = batch.column("doc_id").take(pa.array(w.text_of[word]))
            start = w.index[word] + before
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[begin].view(np.int64)), doc, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                ["m", "doc_id", "start", "n"],
            )


def _edges(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The windows of a document's candidate runs, with digests of themselves and of the words around them (0: none)."""
    for batch in chunks(batches):
        runs = batch.column("runs")
        lists = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
        pairs = runs.flatten()
        start, n = (pairs.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
        text = np.repeat(lists, n)
        spot = np.repeat(start, n) + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        for w, words_before, first, last in _parts(batch, window + 1):  # a word more on either side, for the neighbours
            place = spot - words_before
            # a repeated doc_id may come with another text
            fits = (place >= (0 if first else 1)) & (place + window <= w.count[text] - (0 if last else 1))
            at = np.unique(w.first[text[fits]] + place[fits])
            if not len(at):
                continue
            end = at + window - 1
            own = digests(w.data, w.starts[at], w.ends[end])
            before, after = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for values, some, word in (
                (before, w.index[at] > 0, at - 1), (after, w.index[at] + window < w.count[w.text_of[at]], end + 1),
            ):
                beside, which = np.unique(word[some], return_inverse=True)
                values[some] = (digests(w.data, w.starts[beside], w.ends[beside])[:, 0] | 1)[which]  # never 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[:, 0]), pa.array(own[:, 1]), batch.column("doc_id").take(pa.array(w.text_of[at])),
                    pa.array((w.index[at] + words_before).astype(np.int32)), pa.array(before), pa.array(after),
                ],
                ["h", "g", "doc_id", "start", "before", "after"],
            )


def _paths(edges: DataFrame) -> DataFrame:
    """Maximal nonbranching paths of repeated windows: head and tail window, length, and first coordinate."""
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(2**31).cast("decimal(11,0)") + F.col("start")
    repeated = (
        edges.groupBy("h", "g")
        .agg(
            F.count("*").alias("n"),
            F.min(place.cast("decimal(38,0)")).alias("place"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in ("before", "after") for f in (F.min, F.max)],
        )
        .where("n > 1")
    )
    half = F.lit(2**31).cast("decimal(11,0)")
    start = F.pmod(F.col("place"), half)
    repeated = repeated.select(
        "h", "g", "n", ((F.col("place") - start) / half).cast("long").alias("doc_id"), start.cast("int").alias("start"),
        ((F.col("min_before") == F.col("max_before")) & (F.col("min_before") != 0)).alias("one_before"),
        ((F.col("min_after") == F.col("max_after")) & (F.col("min_after") != 0)).alias("one_after"),
    )
    along = Window.partitionBy("doc_id").orderBy("start")
    joins = (
        (F.lag("start").over(along) == F.col("start") - 1)
        & (F.lag("n").over(along) == F.col("n"))
        & F.lag("one_after").over(along)
        & F.col("one_before")
    )
    marked = repeated.withColumn("head", ~F.coalesce(joins, F.lit(False)))
    ended = marked.withColumn("tail", F.coalesce(F.lead("head").over(along), F.lit(True))).where("head or tail")
    # heads and tails alternate: a head's path ends at itself or at the next row
    until = F.when(F.col("tail"), F.col("start")).otherwise(F.lead("start").over(along))
    tail = lambda c: F.when(F.col("tail"), F.col(c)).otherwise(F.lead(c).over(along)).alias(f"tail_{c}")
    return ended.select("*", (until - F.col("start") + 1).alias("length"), tail("h"), tail("g")).where("head").select(
        "h", "g", "tail_h", "tail_g", "length", F.col("doc_id").alias("first_doc"), F.col("start").alias("first_start")
    )


def _copies(known: DataFrame, kept: Kept) -> DataFrame:
    """The doc_ids of one row whose text a smaller doc_id has as well."""
    digests = kept.keep(known.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest")), "digests")
    groups = digests.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    # kept apart, so that the join can split the rows of a large group
    first = kept.keep(groups.select("digest", "least"), "first")
    single = digests.groupBy("doc_id").agg(F.first("digest").alias("digest"), F.count("*").alias("n")).where("n = 1")
    copies = kept.keep(single.join(first, "digest").where("doc_id > least").select("doc_id"), "copies")
    kept.drop("digests", "first")
    return copies


def _removed(documents: DataFrame, window: int, shingle: int, kept: Kept) -> DataFrame:
    """Per document the spans (start, words) to remove; of copies everything."""
    known = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    copies = _copies(known, kept)
    found = known.mapInArrow(lambda b: _runs(b, window, shingle), _RUN.format(kind))
    runs = kept.keep(found.join(copies, "doc_id", "left_anti").select("m", "doc_id", "start", "n"), "runs")
    # kept apart, so that the join can split the rows of a frequent minimizer
    again = kept.keep(runs.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"), "minimizers")
    shared = runs.join(again, "m")
    lists = kept.keep(shared.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("runs")), "candidates")
    kept.drop("runs", "minimizers")
    found = known.join(lists, "doc_id").mapInArrow(lambda b: _edges(b, window), _EDGE.format(kind))
    edges = kept.keep(found, "edges")
    paths = kept.keep(_paths(edges), "paths")
    path = F.struct("first_doc", "first_start", "length").alias("path")
    ends = paths.select("h", "g", path, F.lit(0).alias("back")).union(
        paths.where("length > 1").select(F.col("tail_h"), F.col("tail_g"), path, F.col("length") - 1)
    )
    at = edges.select("h", "g", "doc_id", "start").join(ends, ["h", "g"])
    spans = (
        at.select("doc_id", (F.col("start") - F.col("back")).alias("start"), "path", "back")
        .where((F.col("doc_id") != F.col("path.first_doc")) | (F.col("start") != F.col("path.first_start")))
        .groupBy("doc_id", "start", "path")
        .agg(F.count_distinct("back").alias("ends"))
        .where(F.col("ends") == F.when(F.col("path.length") > 1, 2).otherwise(1))
    )
    span = F.struct("start", (F.col("path.length") + window - 1).alias("n"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("n")))
    listed = spans.groupBy("doc_id").agg(F.collect_set(span).alias("spans"))
    removed = kept.keep(listed.union(copies.select("doc_id", whole)), "spans")
    kept.drop("copies", "candidates", "edges", "paths")
    return removed


def kept_words(parts: list[bytes], spans: list[dict] | None) -> list[bytes]:
    """The words outside the spans."""
    if not spans:
        return parts
    keep = np.ones(len(parts), dtype=bool)
    for s in spans:
        keep[s["start"] : s["start"] + s["n"]] = False
    return [parts[i] for i in np.flatnonzero(keep)]


def deduplicated(
    documents: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Per row: doc_id, kept_text (the words that stay, joined by spaces), n_words, n_removed and the removed spans.

    Words are what ASCII white space parts, unchanged. A window of ``window`` words goes where the same words start
    earlier as well, in a smaller doc_id or earlier in the document; removal is judged on the input. Null, empty and
    short texts have no window. Rows with a null doc_id take no part and stay whole. Rows that repeat a doc_id are one
    document as far as windows at equal places agree; each row is returned. Empty tables give no rows; further columns
    are not read.
    """
    kept = Kept(documents.sparkSession, "substring")
    removed = _removed(documents, window, shingle, kept)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out, n, gone = [], [], []
            for text, spans in zip(utf8(batch), batch.column("spans").to_pylist()):
                parts = text.split()
                rest = kept_words(parts, spans if len(parts) >= window else None)
                out.append(b" ".join(rest))
                n.append(len(parts))
                gone.append(len(parts) - len(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                ["doc_id", "kept_text", "n_words", "n_removed"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text").join(removed, "doc_id", "left")
    return rows.mapInArrow(without, f"doc_id {kind}, kept_text string, n_words long, n_removed long")
