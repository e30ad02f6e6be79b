"""Words of many texts at once, as positions in one byte array, and hashes of any run of bytes in constant time.

The hash of bytes b[s:e] is the sum of T[b[i]] * P^i over the run, shifted back by P^-s, modulo 2^64; T is a table of
random odd numbers. Prefix sums give it for every run without making the words. Unequal runs can be built that have one
hash, so it serves for candidates and for features; what has to be equal goes by ``digests``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import xxhash

_SPACE = 32
_GAP = re.compile(rb"[\x20\x09-\x0d]")
#: Powers are made for so many places and go on from there by one factor a block.
_BITS = 20


@cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        a = np.full(1 << _BITS, b, dtype=np.uint64)
        a[0] = 1
        both.append(np.multiply.accumulate(a))
    return tuple(both)


@cache
def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over the whole."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of runs of a byte array."""

    def __init__(self, data: np.ndarray, seed: int):
        base = 0x9E3779B97F4A7C15 + 2 * seed
        power, self.back = _powers(base)
        step, table = pow(base, 1 << _BITS, 1 << 64), _table(seed)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        far, near = 1, []
        for at in range(0, len(data), 1 << _BITS):
            part = self.sums[at + 1 : at + 1 + (1 << _BITS)]
            np.cumsum(table[data[at : at + len(part)]] * (power[: len(part)] * np.uint64(far)), out=part)
            part += self.sums[at]
            near.append(pow(far, -1, 1 << 64))
            far = far * step % (1 << 64)
        self.blocks = np.array([*near, pow(far, -1, 1 << 64)], dtype=np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = self.back[starts & ((1 << _BITS) - 1)] * self.blocks[starts >> _BITS]
        return mixed((self.sums[ends] - self.sums[starts]) * back)


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit digests (XXH3) of runs of bytes, as two columns of longs."""
    view = memoryview(np.ascontiguousarray(data))
    found = b"".join([xxhash.xxh3_128_digest(view[s:e]) for s, e in zip(starts.tolist(), ends.tolist())])
    return np.frombuffer(found, dtype=">i8").astype(np.int64).reshape(-1, 2)


def cut(text: bytes, size: int, overlap: int = 0) -> Iterator[tuple[int, bytes, bool]]:
    """Parts of about ``size`` bytes that end at white space, each with the number of words before it and if it is the last.

    A part begins with the last ``overlap`` words of the one before, so every run of one word more is in one part.
    """
    at = before = 0
    while len(text) - at > size:
        end = at + size
        while True:
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
            part = text[at:end]
            n = len(part.split())
            if end == len(text) or n > overlap:
                break
            end += 1
        yield before, part, end == len(text)
        if end == len(text):
            return
        at += len(part.rsplit(None, overlap)[0]) if overlap else len(part)
        before += n - overlap
    yield before, text[at:], True


class Words:
    """Words, parted by ASCII white space, of a list of texts; ``first`` and ``count`` say which are whose."""

    def __init__(self, texts: list[bytes]):
        parts = [t.split() for t in texts]  # of bytes, split() takes space and \t to \r
        self.parts = parts
        self.count = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.first = np.cumsum(self.count) - self.count
        self.data = np.frombuffer(b" ".join([b" ".join(p) for p in parts if p]), dtype=np.uint8)
        gaps = np.flatnonzero(self.data == _SPACE)
        n = int(self.count.sum())
        self.starts = np.concatenate([np.zeros(min(n, 1), dtype=np.int64), gaps + 1])
        self.ends = np.concatenate([gaps, np.full(min(n, 1), len(self.data), dtype=np.int64)])
        self.text_of = np.repeat(np.arange(len(parts)), self.count)
        self.index = np.arange(n) - np.repeat(self.first, self.count)

    def windows(self, width: int) -> np.ndarray:
        """The words at which a window of ``width`` words of one text starts."""
        left = np.repeat(self.count, self.count) - self.index
        return np.flatnonzero(left >= width)
