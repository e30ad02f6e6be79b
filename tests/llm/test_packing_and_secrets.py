"""Pieces put together again, secrets against plain patterns."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from roadlens.llm import packing, secret_scan
from roadlens.llm.queries import vocabulary

V = vocabulary()
TEXTS = [None, "", " ", "a  b", "x\n y", " lead", "trail ", "tab\tand nbsp  here", "<|endoftext|> in text", "don't  stop　now", "é ß 漢字 🙂 x" * 200, "word " * 5000]


def check_pieces(rows, texts):
    """Every id in one piece, right checksums, gapless offsets, sequences of at most 1024."""
    tokenizer = Tokenizer.from_file(V["tokenizer"])
    want = sorted([i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, *ids in want:
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    return sum(1024 - sum(n for _, n in s) for s in sequences.values())


def test_whole_table_packs_tightly(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(3)
    padding = check_pieces(packing.pack(docs, **V).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert padding < 1024


def test_odd_texts(docs_of, none):
    rows = list(enumerate(TEXTS))
    check_pieces(packing.pack(docs_of(rows), **V).collect(), rows)
    repeated = packing.pack(docs_of([(5, "a b"), (5, "a b"), (None, "a b")]), **V).collect()
    assert sorted(r["length"] for r in repeated) == [3, 3, 3] and {r["sequence_id"] for r in repeated} == {repeated[0]["sequence_id"]}
    assert packing.pack(none, **V).count() == 0


def test_blocks_of_a_long_text_give_its_ids(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 3)
    tokenizer, encode = Tokenizer.from_file(V["tokenizer"]), packing.encoder(V["ranks"], V["pattern"]).encode_ordinary
    rnd = random.Random(9)
    bits = [" ", " ", "  ", "\n", "\t", "a", "word", "don't", "12", "é", "漢字", "\u00a0", "\u3000", "\x1c", "\x85", "🙂", "!?", "_"]
    for _ in range(2000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(40)))
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert packing.token_ids(text, encode, V["tokenizer"], ()) == np.array(want, dtype="<u4").tobytes()
        assert "".join(packing._blocks(text)) == text
    assert len(list(packing._blocks("one two three four"))) == 4


@pytest.mark.parametrize("seed", range(5))
def test_costs_are_balanced_and_nothing_is_lost(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 1024, 300)
    placed = packing.assign(lengths, 1.0, 1 / 1024)
    got, load = defaultdict(list), defaultdict(int)
    for piece, start, end, s in placed:
        got[piece].append((start, end))
        load[s] += end - start
    for piece, n in enumerate(lengths):
        at = 0
        for start, end in sorted(got[piece]):
            assert start == at
            at = end
        assert at == n
    assert max(load.values()) <= 1024 and len(load) == -(-int(lengths.sum()) // 1024)


def plain_spans(text):
    assign = re.compile("""(%s)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""" % "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")
    ))
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def test_base_spans():
    rnd = random.Random(4)
    bits = ["password", "API_KEY", "ApiKey", "toKen", "secret", "=", ":", " ", "'", '"', "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "Key", "ſecret=", "x.y/z"]
    for _ in range(400):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(30)))
        assert [(k, s, e) for s, e, k in secret_scan.base_spans(text)] == plain_spans(text)


def test_random_strings_are_found_and_known_kinds_are_not(docs_of, odd, none):
    clean = "https://example.org/a_long_path/to-some-file internationalization_of_everything 123e4567-e89b-12d3-a456-426614174000 readTheDocumentationCarefully"
    rows = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs_of([(1, "é xQ7zK9vT2mLp4RwY8sBn3D ok"), (2, clean)]), V["ranks"], V["pattern"]).collect()}
    assert rows == {1: "random:2:24", 2: ""}
    assert secret_scan.scan(odd, V["ranks"], V["pattern"]).count() == 9
    assert secret_scan.scan(none, V["ranks"], V["pattern"]).count() == 0
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs_of([(1, "a token = 'abcdef12' b"), (2, None)]), V["ranks"], V["pattern"]).collect()}
    assert masked == {1: "a [ASSIGN]' b", 2: None}


def test_random_letters_in_the_form_of_identifiers_are_found(docs_of):
    keys = ["qzxkvjwpqlmzhxcvbngtrk", "qzxvkj-wpqlmz-8321-xkcdq", "QZXKVJWPQLMZHXCVBNGTRK", "qzxkvJwpqlmzHxcvbNgtrk"]
    clean = "internationalization_of_everything a_b_c_d_e_f_g_h_i_j_k_l data/2024-01-05/part-00017 MAX_CHARS_PER_TOKEN_LIMIT getElementByClassName"
    rows = secret_scan.scan(docs_of([*enumerate(keys), (9, clean)]), V["ranks"], V["pattern"]).collect()
    assert {r["doc_id"]: r["spans"] for r in rows} == {**{i: f"random:0:{len(k)}" for i, k in enumerate(keys)}, 9: ""}


def test_what_a_base_span_leaves_of_a_string_is_judged(docs_of):
    access, key, digest = "AKIA" + "ABCDEFGH12345678", "xQ7zK9vT2mLp4RwY8sBn3DxQ7zK9vT2mLp4RwY8s", "0123456789abcdef01234567"
    texts = [f"{access}/{key}", f"{digest}-{key}", f"{key}={digest}+{key}", f"{digest}-some-words-and-more-words"]
    rows = secret_scan.scan(docs_of(list(enumerate(texts))), V["ranks"], V["pattern"]).collect()
    assert [r["spans"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [
        "access:0:20,random:20:61", "hex:0:24,random:24:65", "random:0:41,hex:41:65,random:65:106", "hex:0:24",
    ]
    masked = secret_scan.redact(docs_of([(1, texts[0])]), V["ranks"], V["pattern"]).first()["text"]
    assert masked == "[ACCESS][RANDOM]"


def test_random_strings_by_length_and_alphabet():
    """From 20 characters on, of six alphabets, nearly all are found; words in the form of identifiers are not."""
    import random
    import string

    from roadlens.llm import secret_scan as ss
    from roadlens.llm.queries import vocabulary

    v = vocabulary()
    encode = ss.encoder(v["ranks"], v["pattern"]).encode_ordinary
    alnum = string.ascii_letters + string.digits
    alphabets = [alnum, alnum + "+/", alnum + "_-", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, string.ascii_letters]
    rng = random.Random(1)
    for alphabet in alphabets:
        for n in (20, 24, 32, 40):
            found = 0
            for _ in range(200):
                text = "key " + "".join(rng.choice(alphabet) for _ in range(n)) + " end"
                spans = ss._spans(text, encode)
                found += any(s <= 6 and e >= n + 2 for s, e, _ in spans) or sum(e - s for s, e, _ in spans) > n // 2
            assert found >= 190, (alphabet, n, found)
    words = "customer account balance transaction history service request response handler controller default value update".split()
    for _ in range(500):
        name = rng.choice("_-/").join(rng.choice(words) for _ in range(4))
        assert not ss._spans(f"call {name} now", encode)
