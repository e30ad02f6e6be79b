"""What the operators share: results kept between jobs, byte-sized chunks of a batch, folds and labelled samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.sinks.store import shared_folder

#: Texts are worked on in chunks of about so many bytes, which bounds the arrays of a task.
CHUNK_BYTES = 2_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_end_with_the_job(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


class Kept:
    """Results of one run, written below the shared folder so that they outlive lost executors and cut lineage.

    A later job reads them again; ``drop`` removes what no further job needs. What the returned DataFrame still reads
    stays until the owner of the shared folder removes it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/roadlens-llm-{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with _shuffle_files_end_with_the_job(self.spark):
            df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches where the text reaches ``size`` bytes; a longer text is a chunk of its own."""
    for batch in batches:
        start, filled = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(lengths):
            if filled and filled + (n or 0) > size:
                yield batch.slice(start, i - start)
                start, filled = i, 0
            filled += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch) -> list[str]:
    """The texts; null counts as empty."""
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def utf8(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def id_crc32() -> Column:
    """crc32 of the doc_id as text, null without a doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def in_fold(mod: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text leaves that remainder; false without a doc_id."""
    return F.coalesce(id_crc32() % mod == remainder, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, target: str, train: Column, max_rows: int, seed: int = 7
) -> DataFrame:
    """At most ``max_rows`` documents (text, label) with a label, drawn by a hash of the doc_id.

    Labels other than 0 and 1 don't count; a doc_id with several has the label 1 if any is. A doc_id that repeats stands
    for one of its texts, that with the smallest hash, so rows are bounded however often it does. The drawn ids are
    pairs of numbers, so they are broadcast; only texts that were drawn move, combined by doc_id in each task before.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & train)
    drawn = (
        known.groupBy("doc_id")
        .agg(F.max(F.col(target).cast("int")).alias("label"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    smallest = F.min_by("text", F.struct(F.xxhash64("text"), F.md5(F.col("text").cast("binary"))))
    return texts.groupBy("doc_id", "label").agg(smallest.alias("text")).select("text", "label")
