"""Toxicity, quality and language on held-out rows and odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import language_id, quality, shared, toxicity, words


@pytest.fixture(scope="module")
def tables(spark, folder):
    return [spark.read.parquet(f"{folder}/{t}.parquet").repartition(4) for t in ("documents", "labels")]


def auc(pairs):
    ones, zeros = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("operator, target", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_held_out_labels_are_ranked(tables, operator, target):
    rows = operator(*tables).join(tables[1], "doc_id").where("held_out").collect()
    assert auc([(r["score"], r[target]) for r in rows]) > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_odd_rows(tables, odd, none, operator):
    rows = operator(odd, tables[1]).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert operator(none, tables[1]).count() == 0
    assert operator(odd, tables[1].limit(0)).count() == 9


def test_the_sample_is_bounded_by_rows(spark):
    """However often a drawn doc_id repeats, it gives one row."""
    docs = spark.range(20000).selectExpr("1L doc_id", "concat('text ', id) text").union(spark.range(50).selectExpr("id + 2", "'x'"))
    labels = spark.range(60).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    sample = shared.labelled_sample(docs, labels, "toxic", F.lit(True), 10).collect()
    assert len(sample) <= 10
    every = shared.labelled_sample(docs, labels, "toxic", F.lit(True), 1000)
    assert every.count() == 51 and every.where("text like 'text%'").count() == 1
    assert every.exceptAll(shared.labelled_sample(docs.repartition(7), labels, "toxic", F.lit(True), 1000)).count() == 0


def test_scores_do_not_depend_on_partitions(tables):
    a, b = (toxicity.toxicity(tables[0].repartition(n), tables[1]).collect() for n in (2, 7))
    assert {r["doc_id"]: r["score"] for r in a} == {r["doc_id"]: r["score"] for r in b}


def test_toxicity_scores_by_hand(spark, docs_of):
    """Presence of n-grams, log-count ratios and the logistic sum, recomputed in plain Python from the fitted weights."""
    texts = [("you are bad bad", 1), ("bad you", 1), ("so bad", 1), ("you are good", 0), ("good day", 0), ("a good one", 0), ("day by day", 0)] * 3
    sample = spark.createDataFrame(texts, "text string, label int")
    model = toxicity.fit(sample, max_features=50)
    n1, n0 = 9, 12
    grams = lambda t: {t[i : i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)}
    key = {int(h): g for t, _ in texts for g in grams(t) for h in [toxicity.grams(g)[-1]]}
    weight = {key[int(k)]: w for k, w in zip(model.keys, model.weights)}
    assert len(weight) == 50
    held = {g: [sum(g in grams(t) and y == label for t, y in texts) for label in (0, 1)] for g in weight}
    apart = lambda g: abs(held[g][1] / n1 - held[g][0] / n0)
    others = {g for t, _ in texts for g in grams(t)} - weight.keys()
    count = lambda g: [sum(g in grams(t) and y == label for t, y in texts) for label in (0, 1)]
    assert min(map(apart, weight)) >= max(abs(count(g)[1] / n1 - count(g)[0] / n0) for g in others) - 1e-12
    for g, w in weight.items():  # a weight is the ratio times what the regression learned, so it has the sign of none or the ratio
        ratio = math.log(((held[g][1] + 1) / (n1 + 2)) / ((held[g][0] + 1) / (n0 + 2)))
        assert w * ratio >= -1e-9 or abs(w) < abs(ratio)
    rows = docs_of(["you are BAD", "good", "", None, "day by day so bad", "zz"])
    for r in toxicity.score(rows, model).collect():
        z = model.bias + sum(weight.get(g, 0.0) for g in grams((r["text"] or "").lower()))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_ftrl_steps_by_hand():
    """The proximal updates on dense lists, one coordinate after the other."""
    rng = random.Random(4)
    bits, alpha, beta, l1, l2 = 4, 0.5, 1.0, 0.3, 0.5
    rows = []
    for _ in range(20):
        index = sorted(rng.sample(range(16), 4))
        rows.append((np.array(index), np.array([rng.random() for _ in index]), rng.randrange(2)))
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    ones = sum(r[2] for r in rows)
    share = {0: min(4.0, max(1.0, ones / (20 - ones))), 1: min(4.0, max(1.0, (20 - ones) / ones))}
    for _ in range(3):
        for index, value, y in rows:
            x = {**dict(zip(index.tolist(), value.tolist())), 16: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = share[y] * (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    found, bias = quality.ftrl(rows, bits=bits, alpha=alpha, beta=beta, l1=l1, l2=l2)
    assert np.allclose(found, [weight(i) for i in range(16)], atol=1e-6) and abs(bias - weight(16)) < 1e-9


def test_features_of_a_long_text_come_in_parts(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["ab", "c-d", "e!", "\u00e9"]) for _ in range(rng.randrange(300))).encode() for _ in range(30)]
    whole = quality.features(texts)
    monkeypatch.setattr(quality, "CHUNK_BYTES", 25)
    assert all(np.array_equal(a, b) for a, b in zip(whole, quality.features(texts)))


def test_hashes_go_on_beyond_the_table_of_powers(monkeypatch):
    data = np.frombuffer(random.Random(6).randbytes(5000), dtype=np.uint8)
    starts = np.arange(0, 4900, 7)
    whole = words.Hashes(data, 1).of(starts, starts + 90)
    monkeypatch.setattr(words, "_BITS", 8)
    words._powers.cache_clear()
    short = words.Hashes(data, 1).of(starts, starts + 90)
    words._powers.cache_clear()
    assert np.array_equal(whole, short)


def test_languages_of_held_out_rows(tables):
    rows = language_id.language(tables[0]).join(tables[0].select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95


def test_a_mixture_names_both_languages(tables):
    names, logs = language_id.train(tables[0])
    parts = {r["lang"]: r["text"] for r in tables[0].where("lang in ('en', 'fr') and n_chars > 2000").collect()}
    found = language_id.languages(parts["en"][:2000] + "\n" + parts["fr"][:2000], logs)
    assert {names[i] for i in found} >= {"en", "fr"} and abs(sum(found.values()) - 1) < 1e-6


def test_texts_without_letters_have_no_language(tables, docs_of, none):
    model = language_id.train(tables[0])
    rows = language_id.predict(docs_of([(1, None), (2, ""), (3, "12 %% ²"), (3, "12 %% ²")]), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)] * 4
    assert language_id.language(none).count() == 0
    assert {r["lang_pred"] for r in language_id.language(docs_of([(1, "text")])).collect()} == {"und"}


def test_the_language_set_is_the_best_of_all_subsets():
    """Mixtures of three languages by plain expectation-maximisation, for every subset."""
    from itertools import combinations

    rng = np.random.default_rng(1)
    letters = "abcdefghij"
    weights = {i: rng.dirichlet(np.full(10, 0.3)) for i in range(3)}
    write = lambda i, n: "".join(rng.choice(list(letters), size=n, p=weights[i]))
    counts = np.full((3, language_id.CELLS), 0.01)
    for i in range(3):
        np.add.at(counts[i], language_id.cells(write(i, 30000)), 1)
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))

    def value(found, subset):
        share = {i: 1 / len(subset) for i in subset}
        for _ in range(400):
            parts = {i: 0.0 for i in subset}
            for c in found:
                p = {i: share[i] * math.exp(logs[i][c]) for i in subset}
                for i in subset:
                    parts[i] += p[i] / sum(p.values())
            share = {i: parts[i] / len(found) for i in subset}
        return sum(math.log(sum(share[i] * math.exp(logs[i][c]) for i in subset)) for c in found), share

    for mix in ([0], [1, 2], [0, 1], [0, 1, 2], [2]):
        text = " ".join(write(i, 240) for i in mix)
        found = language_id.cells(text).tolist()
        cost = language_id.PENALTY * math.log(len(found) + 1)
        every = [s for k in (1, 2, 3) for s in combinations(range(3), k)]
        scored = {s: value(found, s) for s in every}
        best = max(every, key=lambda s: scored[s][0] - cost * len(s))
        got = language_id.languages(text, logs)
        assert tuple(sorted(got)) == best == tuple(mix)
        assert all(abs(got[i] - scored[best][1][i]) < 0.02 for i in best)


def test_many_languages_share_a_model_of_fixed_size(spark):
    """Free text in lang: the cells of all languages are bounded, and few languages keep them all."""
    docs = spark.range(3000).selectExpr("id doc_id", "concat('x', id % 300) lang", "repeat(concat(chr(97 + int(id % 20)), 'bc '), 30) text")
    names, logs = language_id.train(docs)
    assert len(names) == 300 and logs.size <= language_id.MODEL and logs.shape[1] == 1 << 13
    rows = language_id.predict(docs.where("doc_id < 300"), (names, logs)).collect()
    assert sum(int(r["lang_pred"][1:]) % 20 == r["doc_id"] % 20 for r in rows) > 290
