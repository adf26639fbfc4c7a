"""Landed report files: listing them, and reading only the ones that are needed."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peakledger.functions import names
from peakledger.functions.shipping import by_value

by_value(__name__)

FILE = "report string, name string, published_at timestamp_ntz, uri string"


def utc(moment: Column) -> Column:
    """A session-zone timestamp as UTC timestamp_ntz, whatever the session's zone."""
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def _named(path: Column) -> list[Column]:
    parts = F.split(path, "/")
    return [F.element_at(parts, -2).alias("report"), F.element_at(parts, -1).alias("name")]


def list_files(spark: SparkSession, root: str, manifest: DataFrame | None = None, wanted_only: bool = True) -> DataFrame:
    """report, name, published_at, uri for files laid out as root/<report>/<file>; contents are not read.

    ``manifest`` (report, name, published_at) holds publish times saved when the files were copied; without an entry the
    file's own time stands in.
    """
    found = spark.read.format("binaryFile").load(f"{root}/*/PUB_*").select(
        *_named(F.col("path")), utc(F.col("modificationTime")).alias("published_at"), F.col("path").alias("uri"))
    if wanted_only:
        found = found.where(names.is_wanted(F.col("report"), F.col("name")))
    if manifest is None:
        return found
    saved = manifest.groupBy("report", "name").agg(F.min("published_at").alias("_saved"))
    return found.join(saved, ["report", "name"], "left").withColumn(
        "published_at", F.coalesce("_saved", "published_at")).drop("_saved")


def place_of(uri: str) -> tuple[str, str]:
    """(store, path in it). file:/a and file:///a name the same file; s3a and s3n are Hadoop's names for s3; an empty authority
    is the default store of its scheme."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return "file:///", "/" + rest.lstrip("/")
    authority, _, path = rest.removeprefix("//").partition("/")
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}", path


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    stores: dict = {}  # one handle per store: two name nodes or buckets have one each
    for batch in batches:
        bodies = []
        for uri in batch.column("uri").to_pylist():
            store, path = place_of(uri)
            if store not in stores:
                stores[store] = (fs.LocalFileSystem(), "") if store == "file:///" else fs.FileSystem.from_uri(f"{store}/")
            system, base = stores[store]
            path = path if store == "file:///" else f"{base.rstrip('/')}/{path}"
            with system.open_input_stream(path) as stream:
                bodies.append(stream.read())
            # one file at a time: an Arrow batch of large files need not fit in memory at once
            yield pa.RecordBatch.from_arrays(
                [c.slice(len(bodies) - 1, 1) for c in batch.columns] + [pa.array([bodies[-1]], pa.binary())],
                names=batch.schema.names + ["content"])
            bodies[-1] = None


def read_bytes(files: DataFrame) -> DataFrame:
    """Adds ``content``. Files are fetched by the tasks that hold their names, spread evenly, so only files left after an
    anti-join are ever opened."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", content binary"
    return files.repartition("report", "name").mapInArrow(_fetch, schema)


def read_texts(files: DataFrame) -> DataFrame:
    """Adds ``text`` (UTF-8)."""
    return read_bytes(files).withColumn("text", F.decode("content", "UTF-8")).drop("content")


def read_folder(spark: SparkSession, root: str, wanted_only: bool = True) -> DataFrame:
    """All (wanted) files under root/<report>/ with their text, in one scan. For first loads, where everything is new."""
    scan = spark.read.text(f"{root}/*/PUB_*", wholetext=True)
    path = F.col("_metadata.file_path")
    files = scan.select(*_named(path), utc(F.col("_metadata.file_modification_time")).alias("published_at"),
                        path.alias("uri"), F.col("value").alias("text"))
    return files if not wanted_only else files.where(names.is_wanted(F.col("report"), F.col("name")))


def archive(listed: DataFrame, held: DataFrame, target: str, fetch=read_bytes) -> DataFrame:
    """Copies what the archive lacks and returns the copied (report, name, published_at).

    Bytes go to parquet partitioned by report, with the publish time kept beside them. ``held``: report, name.
    """
    missing = listed.join(held.select("report", "name").distinct(), ["report", "name"], "left_anti")
    fetch(missing).write.mode("append").partitionBy("report").parquet(target)
    return missing.select("report", "name", "published_at")


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    """Archived files with text: report, name, published_at, uri, text. A file copied twice is kept once."""
    stored = spark.read.schema("name string, published_at timestamp_ntz, uri string, content binary, report string").parquet(target)
    return (stored.dropDuplicates(["report", "name"]).withColumn("text", F.decode("content", "UTF-8"))
            .select("report", "name", "published_at", "uri", "text"))


def load_samples(spark: SparkSession, path: str) -> DataFrame:
    """Load-test samples, one run per file: run, elapsed_s, replicas, lag."""
    rows = spark.read.schema("elapsed_s bigint, replicas bigint, lag bigint").option("header", True).csv(path)
    run = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.csv$", "")
    return rows.select(run.alias("run"), "elapsed_s", "replicas", "lag")
