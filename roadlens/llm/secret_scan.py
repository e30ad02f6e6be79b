"""Secrets in texts: three fixed patterns, and random strings that a tokenizer's vocabulary compresses badly.

Strings of letters, digits and signs are encoded with a tiktoken vocabulary. Words, names and paths consist of frequent
pieces and give many characters a token, random strings give few. Left out before the test are digests (hexadecimal,
their own pattern), UUIDs and numbers. Strings in the form of identifiers (letter runs joined by signs or by change of
case) are judged by their letter runs alone, since signs and numbers between words take tokens too. Spans of the fixed
patterns are cut out, and what is left of a string is judged by itself. Spans are in code points.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import chunks, texts

MIN_LENGTH = 20
#: A random string has fewer characters a token than this.
MAX_CHARS_PER_TOKEN = 2.2

# The patterns of the base kinds, their least lengths, and their order.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_STRING = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_KNOWN = re.compile(
    r"[0-9a-fA-F]+|[0-9_/=+-]+"  # digests, numbers
    r"|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"
)
_IDENTIFIER = re.compile(
    r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[_/=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[_/=+-]*"  # words joined by signs
    r"|[a-z]+(?:[A-Z][a-z]{2,})+[0-9]*|(?:[A-Z][a-z]{2,})+[0-9]*"  # words joined by case
)
#: Shorter runs are one or two tokens whatever they say.
_RUN = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")


@cache
def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file, made once in each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return _ordered(found)


def _ordered(spans):
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def is_random(string: str, encode) -> bool:
    """Whether a string has few characters a token and is no known kind; an identifier if its longer letter runs have."""
    if _KNOWN.fullmatch(string):
        return False
    parts = [string]
    if _IDENTIFIER.fullmatch(string):
        # as words in a text, which is what the vocabulary knows best
        parts = [f" {r.lower()}" for r in _RUN.findall(string) if len(r) > 2]
    return sum(len(p.lstrip()) for p in parts) < MAX_CHARS_PER_TOKEN * sum(len(encode(p)) for p in parts)


def random_spans(text: str, encode, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Strings, or what spans already found leave of them, that are long enough and random, in order of starts."""
    found, starts = [], [s for s, _, _ in taken]
    ends = list(accumulate((e for _, e, _ in taken), max))  # of all spans up to each
    for m in _STRING.finditer(text):
        at, i = m.start(), bisect_right(ends, m.start())
        pieces = []
        while i < len(taken) and starts[i] < m.end():
            pieces.append((at, starts[i]))
            at, i = max(at, ends[i]), i + 1
        pieces.append((at, m.end()))
        found += [(s, e, "random") for s, e in pieces if e - s >= MIN_LENGTH and is_random(text[s:e], encode)]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of overlapping spans replaced by the name of its first kind."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _spans(text: str, encode) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    return _ordered(base + random_spans(text, encode, base))


def scan(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """One row per row of ``documents``: counts of the base kinds, their digest, and all spans.

    ``ranks`` is the path of a tiktoken rank file that every executor has, ``pattern`` the pattern that parts text for
    it. Null and empty texts have no spans and the digest of the empty string; repeated rows give repeated results; a
    null doc_id stays null; empty tables give no rows; further columns are not read.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        for batch in chunks(batches):
            rows = []
            for text in texts(batch):
                spans = _spans(text, encode)
                base = [s for s in spans if s[2] != "random"]
                n = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(documents: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """The same rows and columns with every secret in the text replaced by its kind; null texts stay null."""

    @F.pandas_udf("string")
    def clean(column):
        encode = encoder(ranks, pattern).encode_ordinary
        return column.map(lambda t: None if t is None else masked(t, _spans(t, encode)))

    return documents.withColumn(text, clean(F.col(text)))
