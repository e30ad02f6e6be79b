"""Stretches of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q, at least ``repeats`` times q and ``min_length`` words long, that
neither neighbour extends. Every word of a run is in it at least ``repeats`` times. So a word that occurs less often in
a segment of consecutive words joins no run in it: it splits the segment, what is shorter than a run goes, and the parts
are counted anew, until nothing splits. Of most texts nothing survives.

The lag scan of the surviving segments looks for each period at one scale only: a period in (s/2, s] by the lag from a
place to the next place with the same s words. In a run of a smallest period q <= s these lags are all q (s words occur
nearer only if q is not smallest), from the run's first word on and up to s words before its last repeat; so places side
by side with one lag are a run, from end to end, and no pair of places has to be compared word by word. Names of 2s
words are made from two names of s words, by sorting and not by hashing, so names are exact; only places whose s words
recur go on to the next scale. The work on n words is n log n per scale, and there are log n scales.

Each text is worked on where it is read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import chunks

MIN_LENGTH = 24
REPEATS = 3
_RUN = "start: long, length: long, period: long"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def surviving(word: np.ndarray, part: np.ndarray, repeats: int, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that frequency splitting leaves, in order, and the segment of each.

    ``part`` says which text a word is of; only segments that were cut are counted again.
    """
    kinds = int(word.max(initial=0)) + 1
    at, segment, done = np.arange(len(word)), part.astype(np.int64), []
    while len(at):
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        segment = np.repeat(np.arange(len(first)), size)
        long = (size >= min_length)[segment]
        at, segment = at[long], segment[long]
        _, which, n = np.unique(segment * kinds + word[at], return_inverse=True, return_counts=True)
        rare = n[which] < repeats
        cut = np.zeros(len(first), dtype=bool)
        cut[segment[rare]] = True
        whole = ~cut[segment]
        done.append(at[whole])
        go_on = ~whole & ~rare
        at, segment = at[go_on], segment[go_on]
    at = np.sort(np.concatenate(done)) if done else np.zeros(0, dtype=np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (part[at[1:]] != part[at[:-1]])
    return at, np.cumsum(new) - 1


def _names(*parts: np.ndarray) -> np.ndarray:
    """A number for each distinct tuple."""
    key = parts[0]
    for p in parts[1:]:
        key = key * (int(p.max(initial=0)) + 1) + p
    return np.unique(key, return_inverse=True)[1]


def lag_scan(
    word: np.ndarray, at: np.ndarray, segment: np.ndarray, repeats: int, min_length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (a place in ``word``), length and period of the runs in the segments; the start orders them."""
    # the first scale has to fit between two repeats of the shortest runs
    scale = 1
    while 4 * scale <= min_length // repeats * (repeats - 1):
        scale *= 2
    size = np.bincount(segment)[segment] if len(segment) else np.zeros(0, dtype=np.int64)
    last = np.searchsorted(segment, segment, side="right")
    place = np.arange(len(at))
    name = np.full(len(at), -1, dtype=np.int64)
    name[place] = _names(segment, word[at])
    width, found = 1, []
    while width < scale:  # names of ``scale`` words, of every place that has them
        place = place[place + 2 * width <= last[place]]
        longer = _names(name[place], name[place + width])
        name[:] = -1
        name[place] = longer
        width *= 2
    least = 1
    while len(place):
        order = np.argsort(name[place], kind="stable")
        here, names = place[order], name[place][order]
        same = np.flatnonzero(names[1:] == names[:-1])
        start, lag = here[same], here[same + 1] - here[same]
        fits = (lag >= least) & (lag <= width)
        start, lag = start[fits], lag[fits]
        order = np.argsort(start)
        start, lag = start[order], lag[order]
        new = np.ones(len(start), dtype=bool)
        new[1:] = (np.diff(start) != 1) | (np.diff(lag) != 0)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(start))) - 1 + lag[first] + width
        runs = length >= np.maximum(min_length, repeats * lag[first])
        found.append((start[first][runs], length[runs], lag[first][runs]))
        recurs = np.zeros(len(at), dtype=bool)
        recurs[here[same]] = recurs[here[same + 1]] = True
        place = place[recurs[place] & (size[place] >= repeats * (width + 1))]
        place = place[place + 2 * width <= last[place]]
        place = place[recurs[place + width]]
        longer = _names(name[place], name[place + width])
        name[:] = -1
        name[place] = longer
        least, width = width + 1, 2 * width
    start, length, period = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    order = np.lexsort((period, start))
    return at[start[order]], length[order], period[order]


def _collapsed(batches: Iterator[pa.RecordBatch], repeats: int, min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        split = pc.ascii_split_whitespace(batch.column("text").fill_null(""))
        filled = pc.not_equal(pc.binary_length(split.flatten()), 0)
        text = pc.list_parent_indices(split).filter(filled).to_numpy()
        words = split.flatten().filter(filled)
        count = np.bincount(text, minlength=batch.num_rows)
        first = np.cumsum(count) - count
        word = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        start, length, period = lag_scan(word, *surviving(word, text, repeats, min_length), repeats, min_length)
        edge = np.zeros(len(word) + 1, dtype=np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        keep = np.cumsum(edge)[:-1] == 0
        left = np.bincount(text[keep], minlength=batch.num_rows)
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        rest = pa.ListArray.from_arrays(offsets(left), words.filter(pa.array(keep)))
        of = text[start]
        runs = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(period)], fields=list(_RUN_TYPE.value_type))
        lists = pa.ListArray.from_arrays(offsets(np.bincount(of, minlength=batch.num_rows)), runs)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(count), lists, pc.binary_join(rest, " ")],
            ["doc_id", "n_words", "runs", "collapsed_text"],
        )


def collapsed(documents: DataFrame, repeats: int = REPEATS, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period, by start and then period) and collapsed_text: the
    words no run holds after its first period, joined by spaces.

    Words are what ASCII white space parts, unchanged; places count from 0. ``repeats`` is at least 3 and ``min_length``
    at least 8 times ``repeats``. Null, empty and blank texts have no words and no runs. Rows are judged one by one, so
    repeated doc_ids and null ones are returned as they are; empty tables give no rows; further columns are not read.
    """
    if repeats < 3 or min_length < 8 * repeats:
        raise ValueError("runs need at least 3 repeats and 8 words a repeat in all")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        lambda b: _collapsed(b, repeats, min_length),
        f"doc_id {kind}, n_words long, runs array<struct<{_RUN}>>, collapsed_text string",
    )


def longest(runs: Column) -> Column:
    """The run that repeats most often (length / period, exactly); of equal ones the first of the array; null of none."""
    none = F.lit(None).cast(f"struct<{_RUN}>")

    def better(best: Column, run: Column) -> Column:
        beats = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | beats, run).otherwise(best)

    return F.reduce(runs, none, better)


def looped(words: Column, start: Column, period: Column) -> Column:
    """The words with those from ``start`` on replaced by the first ``period`` of them, over and over."""
    n = F.size(words)
    times = F.ceil((n - start) / period).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    return F.slice(F.concat(F.slice(words, F.lit(1), start), loop), F.lit(1), n)
