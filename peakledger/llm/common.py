"""What the operators share: reading tables, durable intermediate tables, Arrow passes."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.shipping import by_value

#: Rows of an Arrow batch that one step of a Python pass works on; bounds the memory of very long texts.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a folder is chosen here only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    return f"{warehouse.rstrip('/')}-checkpoints"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared folder, so that lost executors cost nothing that was done before."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once as compressed Parquet in the shared folder and read back; for tables too wide for a checkpoint."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once; otherwise the optimizer may repeat it for every element of a lambda."""
    return F.transform(F.array(value), body)[0]


def arrow_pass(df: DataFrame, schema: str, rows: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    """rows: from lists by input column to lists by output column, for a few hundred rows at a time."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                out = rows(batch.slice(at, ROWS_AT_ONCE).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def utf8(column: str = "text") -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """make(), once for each Python worker, however many tasks it runs."""
    kept = vars(sys.modules.setdefault("peakledger_worker", types.ModuleType("peakledger_worker"))).setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


by_value(__name__)
