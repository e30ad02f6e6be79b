"""A corpus pipeline: toxic documents go, near-duplicates go, contaminated documents go, secrets are masked, the rest
is packed into training sequences. Each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import decontamination, packing, secret_scan, simhash_dedup, toxicity
from roadlens.llm.queries import vocabulary
from roadlens.llm.shared import Kept
from roadlens.plans.inputs import table


def _free(name: str, docs: DataFrame) -> str:
    """The name, longer if the documents have a column of that name."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def _digest() -> Column:
    return F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    model, name = toxicity.train(docs, table(spark, sf_dir, "labels")), _free("_toxicity", docs)
    return toxicity.score(docs, model, name=name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group by op7's rule: three-word shingles, at most three of 64 bits.

    A document is a doc_id and a text: one that repeats stays once, texts that share a doc_id are judged apart. Rows
    without a doc_id stay."""
    # rows without a doc_id come last in the order, so they stand for a group only if nothing else is in it
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), _digest().alias("digest"))
    groups = simhash_dedup.near_duplicates(docs.select(key.alias("doc_id"), "text"))
    others = groups.where(~F.col("doc_id.none") & (F.col("doc_id") != F.col("component_id"))).select("doc_id.id", "doc_id.digest")
    digest, gone, text = (_free(name, docs) for name in ("_digest", "_gone", "_gone_text"))
    others = others.distinct().toDF(gone, text)
    left = docs.withColumn(digest, _digest())
    left = left.join(others, (F.col("doc_id") == F.col(gone)) & (F.col(digest) == F.col(text)), "left_anti")
    known = left.where("doc_id is not null").dropDuplicates(["doc_id", digest])
    return known.unionByName(left.where("doc_id is null")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth of the words, each row judged by its text."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), _digest()).cast("binary"))
    judged = decontamination.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    name = _free("_row", docs)
    dirty = judged.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(dirty, name, "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind; n_chars is that of the new text."""
    v = vocabulary()
    clean = secret_scan.redact(docs, v["ranks"], v["pattern"])
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, **vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]
# The trained classifier and the tokenizer are beyond SQL. Tests hold the operators against brute force, and run() against
# plain Python over all pairs and windows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of the folder. A stage's rows go once the next has read them."""
    docs, kept, before = table(spark, sf_dir, "documents"), Kept(spark, "pipeline"), None
    for name, stage in STAGES:
        docs = kept.keep(stage(spark, docs, sf_dir), name)
        if before:
            kept.drop(before)
        before = name
    return docs
