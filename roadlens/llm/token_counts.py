"""Token counts by a BPE tokenizer compiled to finite-state transducers.

A text is split into pieces (runs of letters, single digits, runs of other signs, a few English endings) and each piece
into tokens by merges. Both are transducers here.

* ``Splitter`` has seven states. Each state and class of character tells the next state and whether a piece starts. The
  characters of a batch are cut into short chunks; all chunks at once map every state they may be entered in to the
  state they are left in, the maps compose by a parallel prefix scan, and so every chunk knows the state it is entered
  in before any text was read in order. Which class a character has is asked of the tokenizer, once per character.

* ``Merger`` counts the tokens of a piece. An encoding is right if each two tokens in a row are the encoding of their
  own text, so what comes next depends only on the tokens that may still grow. A state holds these: where each begins
  in the trie of the vocabulary, the token before it, and how many tokens more than the least come before it. Reading a
  byte, the tokens that all of them agree on are done, and the transition says how many. Transitions are made when they
  are first used and are kept up to a number; then they are made anew, so memory is bounded.

Each text is worked on where it is read, long ones in parts that end at white space; nothing is shuffled.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.shared import CHUNK_BYTES, chunks, utf8

#: Transitions and pieces a worker remembers.
REMEMBERED = 400_000
_CHUNK = 256

# Classes of characters, and the states of the splitter: between pieces, in letters, in signs, after an apostrophe that
# starts a piece, and after such an apostrophe and r, v or l.
SPACE, LETTER, DIGIT, SIGN, APOSTROPHE, E, L, R, V, ENDING = range(10)
_BETWEEN, _LETTERS, _SIGNS, _QUOTE, _QUOTE_R, _QUOTE_V, _QUOTE_L = range(7)
_STATES, _CLASSES = 7, 10
_NO_START, _HERE, _BEFORE = 0, 1, 2
# In tables by character, what is no class and what is no character.
_UNKNOWN, _UNASKED, _SEVERAL = 255, 0x110000, 0x110001


def _split_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and where a piece starts (bits: here, one character before), by state and class.

    The pattern: 's 't 're 've 'm 'll 'd, runs of letters, one digit, runs of other signs; the first that fits.
    """
    go, start = np.zeros((_STATES, _CLASSES), np.uint8), np.zeros((_STATES, _CLASSES), np.uint8)
    letters = [LETTER, E, L, R, V, ENDING]
    for state in range(_STATES):
        go[state, SPACE] = _BETWEEN
        go[state, DIGIT], start[state, DIGIT] = _BETWEEN, _HERE
        go[state, letters], start[state, letters] = _LETTERS, _HERE
        go[state, SIGN], start[state, SIGN] = _SIGNS, _HERE
        go[state, APOSTROPHE], start[state, APOSTROPHE] = _QUOTE, _HERE
    start[_LETTERS, letters] = _NO_START
    for state in (_SIGNS, _QUOTE):  # signs go on, apostrophes among them
        go[state, [SIGN, APOSTROPHE]], start[state, [SIGN, APOSTROPHE]] = _SIGNS, _NO_START
    go[_QUOTE, ENDING], start[_QUOTE, ENDING] = _BETWEEN, _NO_START
    for letter, state, second in ((R, _QUOTE_R, E), (V, _QUOTE_V, E), (L, _QUOTE_L, L)):
        go[_QUOTE, letter], start[_QUOTE, letter] = state, _NO_START
        # without the second letter the apostrophe is a piece, and the first letter starts another
        go[state], start[state] = go[_LETTERS], start[_LETTERS] | _BEFORE
        go[state, second], start[state, second] = _BETWEEN, _NO_START
    return go, start


def _looked_up(table: bytes, at: np.ndarray) -> np.ndarray:
    """The bytes of a table of 256 at the given places."""
    return np.frombuffer(at.tobytes().translate(table), dtype=np.uint8).reshape(at.shape)


class Splitter:
    """The pieces of normalised text."""

    def __init__(self, tokenizer):
        self.normalised, self.split = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        go, start = _split_table()
        self.go, self.start = ((t.reshape(-1).tobytes().ljust(256, b"\0")) for t in (go * _CLASSES, start))
        self.kind = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        self.lower = np.full(0x110000, _UNASKED, dtype=np.uint32)
        named = {"'": APOSTROPHE, "e": E, "l": L, "r": R, "v": V, **dict.fromkeys("stmd", ENDING)}
        for c, kind in named.items():
            self.kind[ord(c)] = kind

    def _kind(self, c: str) -> int:
        """What the character does beside a letter and beside itself."""
        if not self.split(c):
            return SPACE
        if len(self.split("a" + c)) == 1:
            return LETTER
        return DIGIT if len(self.split(c + c)) == 2 else SIGN

    def codes(self, text: str) -> np.ndarray:
        """Characters of the normalised text."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = self.normalised(text)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        for code in np.unique(codes[self.lower[codes] == _UNASKED]):
            found = self.normalised(chr(code))
            self.lower[code] = ord(found) if len(found) == 1 else _SEVERAL
        lower = self.lower[codes]
        if (lower == _SEVERAL).any():  # a character becomes several: left to the whole text's normalisation
            lower = np.frombuffer(self.normalised(text).encode("utf-32-le"), dtype="<u4")
        for code in np.unique(lower[self.kind[lower] == _UNKNOWN]):
            self.kind[code] = self._kind(chr(code))
        return lower

    def entered(self, kinds: np.ndarray) -> np.ndarray:
        """The state each chunk (column of classes) is entered in; states count by ``_CLASSES`` here."""
        chunks = kinds.shape[1]
        maps = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None] * _CLASSES, chunks, axis=1).astype(np.uint8)
        for row in kinds:
            maps = _looked_up(self.go, maps + row)
        step = 1
        while step < chunks:  # after each round a map is that of twice as many chunks
            further = np.take_along_axis(maps[:, step:], (maps[:, :-step] // _CLASSES).astype(np.intp), axis=0)
            maps = np.concatenate([maps[:, :step], further], axis=1)
            step *= 2
        return np.concatenate([np.zeros(1, np.uint8), maps[_BETWEEN, :-1]])

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a piece starts at a character."""
        kinds = np.zeros(-(-(len(codes) + 1) // _CHUNK) * _CHUNK, dtype=np.uint8)  # ends with a space at least
        kinds[: len(codes)] = self.kind[codes]
        kinds = np.ascontiguousarray(kinds.reshape(-1, _CHUNK).T)
        state, moves = self.entered(kinds), np.empty_like(kinds)
        for j, row in enumerate(kinds):
            np.add(state, row, out=moves[j])
            state = _looked_up(self.go, moves[j])
        found = _looked_up(self.start, np.ascontiguousarray(moves.T)).reshape(-1)
        return ((found[: len(codes)] & _HERE) | (found[1 : len(codes) + 1] & _BEFORE)) > 0

    def pieces(self, codes: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
        """The pieces, and at which character each starts."""
        first = np.flatnonzero(self.starts(codes))
        solid = self.kind[codes] != SPACE
        kept = codes[solid]
        size = 1 + (kept >= 0x80) + (kept >= 0x800) + (kept >= 0x10000)
        data = kept.astype("<u4").tobytes().decode("utf-32-le").encode()
        end = np.concatenate([[0], np.cumsum(size)])
        offsets = np.append(end[(np.cumsum(solid) - 1)[first]], len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)), first


def _byte_characters() -> list[str]:
    """The character a vocabulary file writes for each byte: itself if it can be seen, else the next above 255."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    above = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(above)) for b in range(256)]


class Merger:
    """Tokens of a piece. A symbol is a byte, or 256 and the byte where the piece ends."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        byte = {c: b for b, c in enumerate(_byte_characters())}

        def symbols(token: str) -> tuple[int, ...]:
            body = token.removesuffix(end) if token != end else token
            out = [byte[c] for c in body]
            return (*out[:-1], out[-1] + 256) if body != token else tuple(out)

        self.symbols = {i: symbols(t) for t, i in vocabulary.items()}
        self.single = {s[0]: i for i, s in self.symbols.items() if len(s) == 1}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}  # rank and both parts
        for n, pair in enumerate(merges):
            pair = pair.split(" ") if isinstance(pair, str) else pair
            left, right, new = vocabulary[pair[0]], vocabulary[pair[1]], vocabulary["".join(pair)]
            if new in self.made_of or any(self.made_of[p][0] > n for p in (left, right) if p in self.made_of):
                raise ValueError("each token has to be made by one merge, after its parts")
            self.rank[left, right], self.made_of[new] = n, (n, left, right)
        self.token_of = {(a, b): new for new, (_, a, b) in self.made_of.items()}
        self.sound: dict[int, bool] = {}
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for i, s in self.symbols.items():
            node = 0
            for x in s:
                if x not in self.child[node]:
                    self.child[node][x] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = self.child[node][x]
            self.token[node] = i
        self._forget()

    def _forget(self) -> None:
        self.states = [((0, None, 0),)]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
        self.made = 0

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """Tokens by merging the pair of the lowest rank, the first of equal ones, again and again."""
        tokens = [self.single[s] for s in symbols]
        while True:
            found = [(self.rank[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in self.rank]
            if not found:
                return tokens
            i = min(found)[1]
            tokens[i : i + 2] = [self.token_of[tokens[i], tokens[i + 1]]]

    def _alone(self, token: int) -> bool:
        """Whether the token is the encoding of its text."""
        if token not in self.sound:
            self.sound[token] = self.merged(self.symbols[token]) == [token]
        return self.sound[token]

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge goes across the border of two tokens.

        Merges come in the order of their ranks, so undoing the later of both neighbours, again and again, shows all
        that ever stood at the border; a pair there would have merged if its rank came first, or of equal ones its place.
        """
        before = len(self.rank)
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < before:
                return False
            a, b = self.made_of.get(left), self.made_of.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                before, left = a[0], a[2]
            else:
                before, right = b[0] + 1, b[1]

    def _follows(self, before: int | None, token: int) -> bool:
        """Whether the token may stand after the one before it: the two are the encoding of their text."""
        return self._alone(token) and (before is None or self._apart(before, token))

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state and the number of tokens that are certain now. After a last byte all are, and the state is 0."""
        growing, ended = [], []
        for node, before, n in self.states[state]:
            child = self.child[node].get(symbol)
            if child is None:
                continue
            token = self.token[child]
            if token is not None and self._follows(before, token):
                ended.append((token, n + 1))
            if self.child[child]:
                growing.append((child, before, n))
        if len(ended) != 1:
            raise ValueError("the merges don't give one encoding for each text")
        token, n = ended[0]
        if symbol >= 256:
            return 0, n
        growing.append((0, token, n))
        least = min(g[2] for g in growing)
        key = tuple((node, before, n - least) for node, before, n in growing)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key], least

    def count(self, piece: bytes) -> int:
        if self.made > REMEMBERED:
            self._forget()
        state = total = 0
        for symbol in (*piece[:-1], piece[-1] + 256):
            known = self.steps[state]
            step = known.get(symbol)
            if step is None:
                step = known[symbol] = self._step(state, symbol)
                self.made += 1
            state, n = step
            total += n
        return total


class Counter:
    """Token counts of texts, by the tokenizer in a file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("added tokens have to stand for themselves")
        names = sorted((re.escape(t.content) for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(names)) if names else None
        self.splitter = Splitter(tokenizer)
        self.merger = Merger(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.known: dict[str, int] = {}

    def _tokens(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[piece] = self.merger.count(piece.encode())
        return n

    def of(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        codes, owner, filled = [], [], 0
        for i, text in enumerate(texts):
            if self.special:
                text, total[i] = self.special.subn("\n", text)  # parts a text as white space does
            for part in parts(text):
                codes.append(self.splitter.codes(part + "\n"))
                owner.append((i, len(codes[-1])))
                filled += owner[-1][1]
                if filled > CHUNK_BYTES:
                    self._add(codes, owner, total)
                    codes, owner, filled = [], [], 0
        self._add(codes, owner, total)
        return total

    def _add(self, codes: list[np.ndarray], owner: list[tuple[int, int]], total: np.ndarray) -> None:
        if not owner:
            return
        pieces, first = self.splitter.pieces(np.concatenate(codes))
        coded = pieces.dictionary_encode()
        n = np.array([self._tokens(p) for p in coded.dictionary.to_pylist()], dtype=np.int64)
        ends = np.cumsum([size for _, size in owner])
        text = np.array([i for i, _ in owner])[np.searchsorted(ends, first, side="right")]
        np.add.at(total, text, n[coded.indices.to_numpy()])


def parts(text: str, size: int = CHUNK_BYTES // 2) -> Iterator[str]:
    """Cut a long text at white space; a part without any is as long as it is."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at + 1, at + size) for c in " \n\t\r")
        if cut < 0:
            found = re.compile(r"[ \n\t\r]").search(text, at + size)
            cut = found.start() if found else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


@cache
def counter(path: str) -> Counter:
    """One counter a worker."""
    return Counter(path)


def counted(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row, as the tokenizers library counts them without special tokens
    of its own; special strings within a text are the tokens they name.

    ``tokenizer`` is a file of that library on every executor: byte-level BPE with word ends, lower case, no white space.
    Null texts count as empty and have 0 of both; rows that repeat are counted each; a null doc_id stays; empty tables
    give no rows; further columns are not read.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in chunks(batches):
            n = count.of([t.decode("utf-8", "replace") for t in utf8(batch)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    return documents.select("doc_id", "text", size).mapInArrow(found, f"doc_id {kind}, n_bytes long, n_tokens long")
