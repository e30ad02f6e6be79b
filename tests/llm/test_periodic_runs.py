"""Runs against all lags and stretches, tried one by one."""

import random
from fractions import Fraction
from hashlib import sha256

import pytest

from roadlens.llm.periodic_runs import collapsed
from roadlens.llm.queries import op11_periodic_runs


def runs_of(w, repeats=3, min_length=24):
    """Every stretch that a lag q keeps equal, if it is long enough and has no smaller period."""
    found, n = [], len(w)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if len(s) >= max(min_length, repeats * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                found.append((i, len(s), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def text_of(rng):
    n, kinds = rng.choice([3, 23, 24, 60, 150, 260]), rng.choice([1, 2, 2, 3, 6])
    w = [rng.choice("abcdef"[:kinds]) for _ in range(n)]
    for _ in range(rng.randrange(3)):  # stretches that repeat, some inside others, and a wrong word
        a = rng.randrange(n)
        p, e = 1 + rng.randrange(max(1, (n - a) // 3)), rng.randrange(a, n + 1)
        w = [w[a + (i - a) % p] if a <= i < e else w[i] for i in range(n)]
    if rng.random() < 0.3:
        w[rng.randrange(n)] = "z"
    return w


def test_random_texts(docs_of):
    rng = random.Random(5)
    texts = [text_of(rng) for _ in range(600)]
    texts += [[str(i) for i in range(100)] * 7 + ["end"], ["x"] * 24, ["x"] * 23, list("ab") * 12, list("abababac") * 5]
    found = collapsed(docs_of([" ".join(w) for w in texts])).collect()
    assert len(found) == len(texts)
    some = 0
    for row in found:
        w = texts[row.doc_id]
        want = runs_of(w)
        assert [tuple(r) for r in row.runs] == want
        assert (row.n_words, row.collapsed_text) == (len(w), kept(w, want))
        some += len(want)
    assert some > 100


def test_other_bounds(docs_of):
    rng = random.Random(6)
    texts = [text_of(rng) for _ in range(200)]
    for row in collapsed(docs_of([" ".join(w) for w in texts]), repeats=4, min_length=40).collect():
        assert [tuple(r) for r in row.runs] == runs_of(texts[row.doc_id], 4, 40)
    with pytest.raises(ValueError):
        collapsed(docs_of(["a"]), repeats=2)


def test_a_word_split_off_later_splits_again(docs_of):
    """Each cut leaves another word too rare, so counting goes on for as many rounds as there are words."""
    w = [x for i in range(60) for x in (f"w{i}", f"w{i}", f"w{i + 1}")] + ["last"]
    assert collapsed(docs_of([" ".join(w)])).first().runs == []


def test_odd_rows(odd, none):
    found = collapsed(odd).collect()
    assert len(found) == odd.count()
    assert {(r.doc_id, r.n_words, r.collapsed_text, len(r.runs)) for r in found if r.doc_id in (1, 2, 3, 6)} == {
        (1, 0, "", 0), (2, 0, "", 0), (3, 0, "", 0), (6, 1, "é" * 30, 0)
    }
    long = next(r for r in found if r.doc_id == 4)
    assert ([tuple(r) for r in long.runs], long.collapsed_text) == ([(0, 120000, 3)], "a b c")
    assert [r.collapsed_text for r in found if r.doc_id in (5, None)].count("same text here") == 3
    assert collapsed(none).collect() == []


def test_white_space_is_ascii(docs_of):
    w = ["a b", "\x1cc", "d "]
    row = collapsed(docs_of(["\t " + "\n\x0b".join(w * 9) + " \r\x0c"])).first()
    assert (row.n_words, row.collapsed_text, [tuple(r) for r in row.runs]) == (27, " ".join(w), [(0, 27, 3)])


def test_query_on_looped_documents(spark, docs_of, tmp_path):
    import zlib

    rng = random.Random(7)
    docs = [(i, None if i % 50 == 7 else " ".join(text_of(rng))) for i in range(400)] + [(None, "a " * 30)]
    docs_of(docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        w = (text or "").split()
        h = 1 if i is None else zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(n)]
        runs = runs_of(w)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        row = found[i]
        assert (row.n_runs, row.runs_sha256) == (len(runs), sha256(lines.encode()).hexdigest())
        assert row.collapsed_sha256 == sha256(kept(w, runs).encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
