"""Packing of tokenized documents into sequences, balanced by attention cost.

A document's tokens are cut into full sequences and one remainder. A full sequence stands alone. Remainders are dealt
evenly to groups of about ``GROUP`` pieces by their row number, whatever their keys. In a group the number of sequences
is what its tokens need; the remainders, longest first, each go to the sequence with the lowest cost so far that can
still hold them, the cost of a piece being linear plus quadratic in its length. What no sequence can hold whole is cut
over those with room. So a group leaves less than one sequence of padding, and a task holds one group.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.secret_scan import encoder
from roadlens.llm.shared import Kept, chunks, texts

LENGTH = 1024
GROUP = 4096
END = 0
#: Long texts are encoded in blocks of about so many characters, which bounds what a task holds beside the text.
BLOCK = 1_000_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PIECE = "row long, doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


@cache
def _tokenizer(tokenizer: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def _blocks(text: str) -> Iterator[str]:
    """The text in blocks of about ``BLOCK`` characters, each cut before a space that stands between two others.

    The tokenizer's pattern never joins characters across such a space, so blocks may be encoded by themselves.
    """
    start = 0
    while cut := _CUT.search(text, start + BLOCK):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str, encode: Callable[[str], list[int]], tokenizer: str, special: tuple[str, ...]) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit numbers, the end id included."""
    if any(s in text for s in special):  # only the tokenizer itself knows its special tokens
        found = [_tokenizer(tokenizer).encode(text, add_special_tokens=False).ids]
    else:
        found = map(encode, _blocks(text))
    return b"".join(np.array(ids, dtype="<u4").tobytes() for ids in [*found, [END]])


def pieces(documents: DataFrame, tokenizer: str, ranks: str, pattern: str, special: tuple[str, ...]) -> DataFrame:
    """Full sequences and remainders of every row, remainders with their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = token_ids(text, encode, tokenizer, special)
                n = len(ids) // 4
                for start in range(0, n, LENGTH):
                    piece = ids[4 * start : 4 * (start + LENGTH)]
                    size = len(piece) // 4
                    rows.append((doc_id, start, size, zlib.crc32(piece), n, None if size == LENGTH else piece))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = documents.select("doc_id", "text").mapInArrow(cut, _PIECE.format(kind).removeprefix("row long, "))
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def assign(lengths: np.ndarray, linear: float, quadratic: float, size: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(piece, from, to, sequence) for pieces shorter than ``size``, in the order in which sequences are filled."""
    room = np.full(-(-int(lengths.sum()) // size), size, dtype=np.int64)
    cost = np.zeros(len(room))
    placed, left = [], []

    def put(piece: int, start: int, end: int, s: int) -> None:
        n = end - start
        placed.append((piece, start, end, s))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        open_ = np.where(room >= n, cost, np.inf)
        s = int(open_.argmin())
        if np.isfinite(open_[s]):
            put(int(i), 0, n, s)
        else:
            left.append(int(i))
    for i in left:  # cut: the roomiest sequences first, so into few parts
        at, n = 0, int(lengths[i])
        while at < n:
            s = int(room.argmax())
            end = min(n, at + int(room[s]))
            put(i, at, end, s)
            at = end
    return placed


def pack(
    documents: DataFrame, tokenizer: str, ranks: str, pattern: str, special: tuple[str, ...] = ("<|endoftext|>",),
    linear: float = 1.0, quadratic: float = 1.0 / LENGTH,
) -> DataFrame:
    """One row per piece, with the sequence it is in and its offset there.

    ``tokenizer`` is a tokenizers file and ``ranks`` the same vocabulary as tiktoken ranks; every executor has both.
    Null and empty texts are one end id; repeated rows and equal doc_ids are packed one by one; a null doc_id stays
    null; an empty table gives no rows; further columns are not read.
    """
    kept = Kept(documents.sparkSession, "packing")
    cut = kept.keep(pieces(documents, tokenizer, ranks, pattern, special), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = cut.where(F.col("length") == LENGTH).select(
        *columns, (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.where(F.col("length") < LENGTH)
    groups = max(1, -(-rest.count() // GROUP))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def packed(key: tuple[int, ...], group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        used: dict[int, int] = {}
        rows = []
        for i, start, end, s in assign(group["length"].to_numpy(), linear, quadratic):
            ids = group["ids"][i]
            crc = zlib.crc32(ids[4 * start : 4 * end])
            rows.append((i, start, end - start, crc, (key[0] << 24 | s) * 2 + 1, used.get(s, 0)))
            used[s] = used.get(s, 0) + end - start
        out = pd.DataFrame(rows, columns=["i", "from", "length", "ids_crc32", "sequence_id", "offset"])
        whole = group.iloc[out["i"]].reset_index(drop=True)
        return pd.DataFrame(
            {"doc_id": whole["doc_id"], "start": whole["start"] + out["from"], "length": out["length"], "ids_crc32": out["ids_crc32"],
             "doc_tokens": whole["doc_tokens"], "sequence_id": out["sequence_id"], "offset": out["offset"]}
        )

    by = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    filled = rest.withColumn("group", by).groupBy("group").applyInPandas(packed, schema)
    return whole.unionByName(filled)
