"""The shared folder, and results that a stream appends batch by batch, on plain Parquet.

Each micro-batch writes its rows into its own folder ``batch_id=N``. A batch that is run again after a failure
replaces its own folder, so writing is idempotent. What is read again while it grows belongs into a ``sinks.log``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the checkpoint folder the session was given by name."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back, which cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/roadlens-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make the store readable before its first batch; a store that is there stays as it is."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch_id=-1")


def _named(spark: SparkSession, folder: str, name: str) -> str:
    """The name a folder was given first."""
    spark.createDataFrame([(name,)], "run string").coalesce(1).write.mode("ignore").text(folder)
    return spark.read.text(folder).first()[0]


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A name for the run of a checkpoint, which is made with it and stays."""
    return _named(spark, f"{checkpoint}/_run", uuid.uuid4().hex)


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Tie a store to the checkpoint that numbers its batches; fail if it belongs to another one.

    A new checkpoint numbers from 0 again, so its rows would replace those of earlier batches. It needs its own store.
    """
    own = run_of(spark, checkpoint)
    if _named(spark, f"{path}/_run", own) != own:
        raise ValueError(f"the store {path} belongs to another checkpoint than {checkpoint}")


def put(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_all(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every row of every batch, with its batch_id."""
    return spark.read.schema(T.StructType([*schema, T.StructField("batch_id", T.LongType())])).parquet(path)
