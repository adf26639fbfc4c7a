"""One table of counters: what each batch of each job saw, parsed, skipped, refused, sent and wrote, and how its queries went.

Every number is taken in a pass the job makes anyway. The rows of a batch are those of its last try.
"""

from __future__ import annotations

import json
import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from peakledger.functions import clock

SUMS = ("files_parsed", "files_failed", "files_skipped", "events_produced", "events_deduplicated", "events_invalid", "events_written")
ROW = ("report string, " + ", ".join(f"{c} bigint" for c in SUMS)
       + ", newest_published timestamp_ntz, batch_seconds double, measured_at timestamp_ntz")
PROGRESS = "batch_id bigint, ts string, input_rows bigint, rows_per_second double, seconds double"


def _write(spark: SparkSession, rows: list[dict], schema: str, folder: str) -> None:
    """A few rows as JSON, made without a Python worker."""
    texts = spark.createDataFrame([], "t string") if not rows else spark.range(1).select(
        F.explode(F.array(*[F.lit(json.dumps(r, default=datetime.isoformat)) for r in rows])).alias("t"))
    texts.select(F.from_json("t", schema).alias("r")).select("r.*").coalesce(1).write.mode("overwrite").json(folder)


def record(spark: SparkSession, root: str, source: str, run: str, batch: str | int, rows: list[dict]) -> None:
    """``rows``: counters of one batch by name, one row a report or one for all; what is absent is null."""
    _write(spark, rows, ROW, f"{root}/source={source}/run={run}/batch={batch}")


def rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{ROW}, source string, run string, batch string").option("basePath", root).json(f"{root}/source=*")


def totals(counted: DataFrame) -> DataFrame:
    """source, report, batches, files_seen, and each counter summed (0 where nothing was counted); ``report`` is null for jobs that
    count over all reports."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]
    seen = F.col("files_parsed") + F.col("files_failed") + F.col("files_skipped")
    return (counted.groupBy("source", "report").agg(F.count_distinct("run", "batch").alias("batches"), *sums)
            .select("source", "report", "batches", seen.alias("files_seen"), *SUMS))


def health(counted: DataFrame, as_of: Column) -> DataFrame:
    """Per source: age in seconds of the newest publication, events a second and 95th percentile of the seconds of its batches.

    The percentile comes from a sketch whose size does not grow with the number of batches.
    """
    timed = counted.where(F.col("batch_seconds").isNotNull())
    age = clock.seconds_between(F.max("newest_published"), as_of).cast("double")
    return timed.groupBy("source").agg(
        F.count(F.lit(1)).alias("batches"), age.alias("age_s"),
        F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double("batch_seconds"), F.lit(0.95)).alias("batch_p95_s"),
        (F.sum("events_written") / F.sum("batch_seconds")).alias("events_per_second"))


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of every batch that read rows, of all queries of the session, as rows under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        row = {"batch_id": p.batchId, "ts": p.timestamp, "input_rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond,
               "seconds": p.durationMs.get("triggerExecution", 0) / 1000}
        try:
            _write(self.spark, [row], PROGRESS, f"{self.root}/query={p.name or p.id}/run={p.runId}/batch={p.batchId}")
        except Exception:  # noqa: BLE001 - a lost row of progress must not touch the query
            logging.getLogger(__name__).exception("progress of batch %s was not kept", p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress(spark: SparkSession, root: str) -> DataFrame:
    """query, run, batch_id, ts, input_rows, rows_per_second, seconds."""
    kept = spark.read.schema(f"{PROGRESS}, query string, run string, batch string").option("basePath", root).json(f"{root}/query=*")
    return kept.drop("batch")
