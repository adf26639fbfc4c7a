"""Topics into the demand tables, one micro-batch at a time."""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from peakledger.functions import contract
from peakledger.streaming import counters, topics
from peakledger.streaming.warehouse import Warehouse, utc_now

FLUSH_SECONDS = 60  # fixed value: how often a live batch is written


class Consumer:
    """The body of the stream. A failed write raises, so the batch is not marked as done and is read again; the merges make a
    second attempt harmless."""

    def __init__(self, warehouse: Warehouse, quarantine: str, name: str = "demand", metrics: str | None = None, attempt: str = "first"):
        self.warehouse, self.quarantine, self.name, self.metrics, self.attempt = warehouse, quarantine, name, metrics, attempt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        begun = time.monotonic()
        checked = topics.judged(batch).persist()
        whole = F.size("violations") == 0
        # Counted by the write below, whose tasks count once each, however often they are tried.
        seen = Observation()
        counted = checked.observe(seen, F.count_if(~whole).alias("events_invalid"), F.count_if(whole).alias("events_written"),
                                  F.max(F.when(whole, contract.field("published_at"))).alias("newest_published"))
        try:
            # the same folder on every try of this batch, another one in a replay from another checkpoint
            (counted.where(~whole).select("key", "value", "topic", "violations").write.mode("overwrite")
             .parquet(f"{self.quarantine}/source={self.name}/run={self.attempt}/batch={batch_id}"))
            self.warehouse.write_batch(contract.decode(checked))
            if self.metrics:
                timed = {"batch_seconds": round(time.monotonic() - begun, 3), "measured_at": utc_now()}
                counters.record(batch.sparkSession, self.metrics, self.name, self.attempt, batch_id, [seen.get | timed])
        finally:
            checked.unpersist()


def run(spark: SparkSession, topic_root: str, warehouse: Warehouse, checkpoint: str, quarantine: str, name: str = "demand",
        live: bool = False, files_per_batch: int | None = None, metrics: str | None = None, kafka: dict | None = None):
    """Start the consumer. Live runs write every minute; a replay takes everything there is and stops.

    A replay from the beginning is a run with a new checkpoint folder. What it sets aside and measures is kept apart by that folder.
    """
    attempt = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    source = topics.stream(spark, topic_root, files_per_batch=files_per_batch, kafka=kafka)
    trigger = {"processingTime": f"{FLUSH_SECONDS} seconds"} if live else {"availableNow": True}
    return (source.writeStream.queryName(name).foreachBatch(Consumer(warehouse, quarantine, name, metrics, attempt))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def progress_rows(spark: SparkSession, query) -> DataFrame:
    """The query's recent progress as rows: batch, rows in, rows per second, seconds. Idle triggers report too."""
    rows = [(p["name"], int(p["batchId"]), p["timestamp"], int(p["numInputRows"]), float(p.get("processedRowsPerSecond") or 0.0),
             float(p["durationMs"].get("triggerExecution", 0)) / 1000) for p in query.recentProgress]
    return spark.createDataFrame(rows, "name string, batch_id bigint, ts string, input_rows bigint, rows_per_second double, seconds double")
