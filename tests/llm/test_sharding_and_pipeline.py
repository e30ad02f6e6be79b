"""Shards: the law, slots and groups. The pipeline: each stage keeps and drops what it should."""

import zlib
from collections import Counter, defaultdict

from roadlens.llm import sharding


def check(rows):
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes[s] for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(3)
    rows, texts = sharding.sharded(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}
    check(rows)
    groups = defaultdict(set)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        groups[raw].add(r["shard"])
    assert len(rows) == len(texts) and sum(len(g) > 1 for g in groups.values()) <= 7


def test_a_group_larger_than_a_shard_is_split_evenly(docs_of):
    rows = sharding.sharded(docs_of([(i, "same") for i in range(100)] + [(i, f"t{i // 2}") for i in range(100, 300)])).collect()
    check(rows)
    assert 3 <= len({r["shard"] for r in rows if r["doc_id"] < 100}) <= 5


def test_small_groups_beside_a_large_one_stay_whole(docs_of):
    rows = sharding.sharded(docs_of([(i, "same") for i in range(600)] + [(i, f"t{i // 2}") for i in range(600, 1800)])).collect()
    check(rows)
    shards = defaultdict(set)
    for r in rows:
        if r["doc_id"] >= 600:
            shards[r["doc_id"] // 2].add(r["shard"])
    assert len(shards) == 600 and sum(len(s) > 1 for s in shards.values()) <= 7


def cut(rows, texts):
    """Links between copies that lie on different shards, a group counting as a chain by its most frequent shard."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[texts[r["doc_id"]]][r["shard"]] += 1
    return sum(sum(g.values()) - max(g.values()) for g in groups.values())


def test_rounds_of_propagation_decide_on_the_shards(docs_of):
    """Hubs of many copies beside pairs: without rounds the copies stay where the hash put them."""
    texts = {i: f"hub{i % 20}" if i < 350 else f"pair{i // 2}" if i < 1150 else f"one{i}" for i in range(2000)}
    docs = docs_of(list(texts.items()))
    found = [sharding.sharded(docs, rounds=n).collect() for n in (0, 1, 5)]
    for rows in found:
        check(rows)
    cuts = [cut(rows, texts) for rows in found]
    assert cuts[0] > 500 and cuts[1] <= 8 and cuts[2] <= 8
    # documents with links are where the labels of the last round put them: none moved while others could
    split = [t for t, n in Counter(texts.values()).items() if n > 1 and len({r["shard"] for r in found[2] if texts[r["doc_id"]] == t}) > 1]
    assert split == []


def test_a_table_of_groups_alone_is_even_and_splits_few(docs_of):
    texts = {i: f"g{i // 10}" for i in range(803)}
    rows = sharding.sharded(docs_of(list(texts.items()))).collect()
    check(rows)
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7


def test_odd_rows(odd, none):
    rows = sharding.sharded(odd).collect()
    check(rows)
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows if r["size"] == 1) == [(0, 1), (1, 1), (2, 1)]
    assert sharding.sharded(none).count() == 0


def test_plans_have_no_python(spark, small, monkeypatch):
    """Of every step that is written, and of the result."""
    plans, keep = [], sharding.Kept.keep

    def seen(self, df, name):
        plans.append(df._jdf.queryExecution().toString())
        return keep(self, df, name)

    monkeypatch.setattr(sharding.Kept, "keep", seen)
    plans.append(sharding.sharded(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString())
    assert len(plans) > 8 and not any(word in plan for plan in plans for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_stages(spark, folder, small):
    import corpus_pipeline as p

    docs, before = spark.read.parquet(f"{small}/documents.parquet"), None
    for name, stage in p.STAGES[:4]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        ids = {r["doc_id"] for r in out.collect()}
        assert ids <= {r["doc_id"] for r in docs.collect()} and ids, name
        before = before or ids
    # near-duplicates: exact copies leave one
    texts = [r["text"] for r in p.drop_near_duplicates(spark, docs, small).collect()]
    assert len(texts) == len(set(texts))


def test_stages_take_odd_rows(spark, odd, none, small):
    import corpus_pipeline as p

    sizes = {"toxicity": 9, "near_duplicates": 6, "decontamination": 9, "secrets": 9}
    for name, stage in p.STAGES:
        assert stage(spark, none, small).count() == 0
        if name in sizes:
            assert stage(spark, odd, small).count() == sizes[name], name


def test_stages_judge_rows_and_not_ids(spark, docs_of, small):
    import corpus_pipeline as p
    from pyspark.sql import functions as F

    found = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    one, two = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    docs = docs_of([(1, one), (5, one), (5, two), (5, two), (7, two), (7, "other"), (None, one)])
    assert found(p.drop_near_duplicates(spark, docs, small)) == sorted([(1, one), (5, two), (7, "other"), (None, one)], key=repr)
    bad = spark.read.parquet(f"{small}/benchmark.parquet").where("length(text) > 50").first()["text"]
    docs = docs_of([(1, one), (2, bad), (3, bad), (3, two), (None, bad), (None, two)])
    assert found(p.drop_contaminated(spark, docs, small)) == sorted([(1, one), (3, two), (None, two)], key=repr)
    kept = p.drop_toxic(spark, docs.withColumn("_toxicity", F.lit(3.0)), small)
    assert {r["_toxicity"] for r in kept.collect()} == {3.0}


def test_run_against_plain_python(spark, folder, docs_of, tmp_path):
    """Every stage over a planted table: scores of the trained model, all pairs, all windows, ids of the tokenizer."""
    import itertools
    import re

    import corpus_pipeline as p
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from roadlens.llm import secret_scan, simhash_dedup, toxicity
    from roadlens.llm.queries import vocabulary

    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    rows = tables["documents"].where("n_chars < 3000").limit(250).collect()
    bad = [r["text"] for r in tables["benchmark"].where("length(text) > 60").limit(3).collect()]
    texts = {r["doc_id"]: r["text"] for r in rows}
    top = 10 + max(i for i in texts if i is not None)
    texts |= {top + i: t for i, t in enumerate(list(texts.values())[:20])}  # copies
    texts |= {top + 100 + i: b for i, b in enumerate(bad)}
    texts |= {top + 200: "the password = hunter2hunter2 is here", top + 201: None, top + 202: ""}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        tables[t].write.parquet(f"{tmp_path}/{t}.parquet")

    score = toxicity.train(docs, tables["labels"]).scorer()
    left = {i: t for i, t in texts.items() if score(t or "") < 0.5}
    prints = dict(zip(left, simhash_dedup.fingerprints([(t or "").encode() for t in left.values()]).tolist()))
    root = {i: i for i in left}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(sorted(left), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    left = {i: t for i, t in left.items() if find(i) == i}
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    windows = set()
    for r in tables["benchmark"].collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}

    def dirty(text):
        w, hit = words(text), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        return bool(hit) and 20 * len(hit) >= len(w)

    assert any(dirty(t) for t in left.values())
    left = {i: t for i, t in left.items() if not dirty(t)}
    v = vocabulary()
    clean = {r["doc_id"]: r["text"] or "" for r in secret_scan.redact(docs.where(docs.doc_id.isin(list(left))), v["ranks"], v["pattern"]).collect()}
    assert top + 200 not in clean or "hunter2" not in clean[top + 200]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: t.encode(x, add_special_tokens=False).ids + [0] for i, x in clean.items()}

    found = defaultdict(list)
    for r in p.run(spark, str(tmp_path)).collect():
        found[r["doc_id"]].append(r)
    assert found.keys() == left.keys() and len(left) < len(texts)
    for i, pieces in found.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[i]))
            part = np.array(ids[i][at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids[i])
