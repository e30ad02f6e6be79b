"""One query per operator over the tables of a test-data folder, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import (
    decontamination, language_id, merkle_manifest, packing, periodic_runs, quality, secret_scan, sharding,
    simhash_dedup, substring_dedup, token_counts, topk_search, toxicity,
)
from roadlens.llm.shared import id_crc32
from roadlens.plans.inputs import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> dict[str, str]:
    """Where the installed public tokenizers are: the tokenizers file, the same vocabulary as ranks, the pattern."""
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


@query
def op1_substring_dedup(spark, d):
    found = substring_dedup.deduplicated(table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query
def op2_toxicity(spark, d):
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op3_decontamination(spark, d):
    found = decontamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op4_topk_search(spark, d):
    rows = table(spark, d, "embeddings")
    return topk_search.top_k(rows, rows.where(F.col("vec_id") % 100 == 0))


@query
def op5_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), **vocabulary())


@query
def op6_secret_scan(spark, d):
    v = vocabulary()
    return secret_scan.scan(table(spark, d, "documents"), v["ranks"], v["pattern"])


@query
def op7_simhash_dedup(spark, d):
    return simhash_dedup.near_duplicates(table(spark, d, "documents"))


@query
def op8_language_id(spark, d):
    return language_id.language(table(spark, d, "documents"))


@query
def op9_quality(spark, d):
    return quality.quality(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op10_sharding(spark, d):
    return sharding.sharded(table(spark, d, "documents"))


@query
def op11_periodic_runs(spark, d):
    """A tenth of the documents, by a checksum of the doc_id, are judged with their words looped from some word on."""
    docs = table(spark, d, "documents")
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    n, g = F.size(words), F.floor(id_crc32() / 10)
    start = (g % F.nullif(n, F.lit(0))).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    text = F.array_join(periodic_runs.looped(words, start, period), " ")
    looped = F.when((id_crc32() % 10 == 0) & (n > 0), text).otherwise(F.col("text"))
    found = periodic_runs.collapsed(docs.select("doc_id", looped.alias("text")))
    best = periodic_runs.longest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


@query
def op12_token_counts(spark, d):
    import public_tokenizers

    found = token_counts.counted(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op13_merkle_manifest(spark, d):
    """Of a seventh of the documents, by a checksum of the doc_id, a leaf with a wrong n_chars is held against the root."""
    docs = table(spark, d, "documents")
    leaf = lambda n_chars: merkle_manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    wrong = F.when(id_crc32() % 7 == 0, leaf(F.col("n_chars").cast("decimal(38,0)") + 1)).alias("claimed")
    found = merkle_manifest.witnessed(docs, leaf(F.col("n_chars")), carry=[wrong])
    root, hex_of = merkle_manifest.hex_of(F.col("root")), merkle_manifest.hex_of
    result = found.select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), root.alias("root"),
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle_manifest.folded(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
