"""Counts against the tokenizers library, on documents and on made-up texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadlens.llm import token_counts
from roadlens.llm.queries import op12_token_counts
from roadlens.llm.token_counts import Counter, counted, parts
from roadlens.plans.inputs import table

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = (
    "a b ' s t r e v l m d 1 ٣ é É İ Σ ς ß - ! '' 've 'RE 'l 中 文 가 ᄀ ᅡ ́ 😀 👩‍👩‍👧 <|endoftext|> <|startoftext|> <| |> Å K ſ ﬁ th ing क़ ⅷ ² ½ _ the tion"
).split(" ") + [" ", " ", "　", "\n", "\t", "\x1c", "\x85", "​", "﻿", "\x00"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_documents(spark, folder, library):
    docs = {r.doc_id: r.text or "" for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    want = dict(zip(docs, library(list(docs.values()))))
    found = op12_token_counts(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want[r.doc_id], len(docs[r.doc_id].encode()), want[r.doc_id] > 2048)


def test_made_up_texts(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(30))) for _ in range(8000)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 30))) for _ in range(8000)]
    texts += ["".join(chr(rng.choice([i, i + 1]) if not 0xD7FE < i < 0xE000 else 65) for i in rng.sample(range(1, 0x2FFFF), 9)) for _ in range(8000)]
    assert Counter(PATH).of(texts).tolist() == library(texts)


def test_transitions_are_forgotten_and_made_anew(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 12))) for _ in range(9)) for _ in range(300)]
    counter = Counter(PATH)
    assert counter.of(texts).tolist() == library(texts)
    assert len(counter.known) <= 50 + 9 * 300 and counter.merger.made < 2 * 50


def test_chunks_and_parts_agree(library, monkeypatch):
    """Maps of short chunks compose across texts, and long texts are cut without a trace."""
    monkeypatch.setattr(token_counts, "_CHUNK", 3)
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 40)
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(200))) for _ in range(400)]
    assert Counter(PATH).of(texts).tolist() == library(texts)
    for text in texts:
        assert "".join(parts(text, 10)) == text


def test_long_pieces(library):
    texts = ["ab" * 20000, "!" * 30000 + "'s", "中文" * 10000, "a\n" * 10000, "'" * 9999 + "re"]
    assert Counter(PATH).of(texts).tolist() == library(texts)


def test_odd_rows(odd, none, library):
    found = counted(odd, PATH).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    assert len(found) == odd.count()
    for r in found:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), library([texts[r.doc_id]])[0])
    assert sorted((r.n_bytes, r.n_tokens) for r in found if r.doc_id is None) == [(0, 0), (14, 3)]
    assert counted(none, PATH).collect() == []
