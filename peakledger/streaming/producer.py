"""Landed files into topics: the file source remembers which files it has taken, the keyed state lives in the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.functions import names
from peakledger.plans import ingest
from peakledger.sources import listing_stream
from peakledger.sources.files import utc
from peakledger.streaming.evaluator import utc_now
from peakledger.streaming.warehouse import Warehouse


def file_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """report, name, published_at, uri, text of new files under root/<report>/, wanted ones only."""
    reader = spark.readStream.option("latestFirst", "false")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("_metadata.file_path")
    parts = F.split(path, "/")
    files = reader.text(f"{root}/*/PUB_*", wholetext=True).select(
        F.element_at(parts, -2).alias("report"), F.element_at(parts, -1).alias("name"),
        utc(F.col("_metadata.file_modification_time")).alias("published_at"), path.alias("uri"), F.col("value").alias("text"))
    return files.where(names.is_wanted(F.col("report"), F.col("name")) & F.col("report").isin(*names.EVENT_REPORTS))


def run(spark: SparkSession, root: str, warehouse: Warehouse, topic_root: str, checkpoint: str, reason: str = "live",
        name: str = "producer", always: bool = False, files_per_batch: int | None = None, now=utc_now,
        metrics: str | None = None, listing: dict | None = None):
    """Live and backfill are the same job; the reason tells them apart.

    With ``listing`` (options of ``listing_stream.listed``) new files are found by the index pages under ``root``, and their publish times
    are those of the pages; otherwise by the folders.
    """
    def send(batch: DataFrame, batch_id: int) -> None:
        ingest.deliver(batch, warehouse, topic_root, reason, now(), f"{name}-{batch_id}", metrics=metrics)

    trigger = {"processingTime": "10 minutes"} if always else {"availableNow": True}
    found = file_stream(spark, root, files_per_batch) if listing is None else listing_stream.file_stream(spark, root, **listing)
    return (found.writeStream.queryName(name).foreachBatch(send)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
