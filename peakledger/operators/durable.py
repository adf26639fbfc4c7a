"""Cutting lineage where it survives the loss of an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Only a local session may fall back, to one beside its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-checkpoints"


def checkpoint(df: DataFrame) -> DataFrame:
    """Written to the shared folder once; every later use reads the same rows."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Written to the shared folder as Parquet and read back, so that its size is known to the plans that use it.

    ``by`` names a column to partition by; its rows are brought together first, and a value that holds much is split at run time.
    """
    folder = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if by is None:
        df.write.parquet(folder, compression=codec)
    else:
        df.hint("rebalance", by).write.partitionBy(by).parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
