"""Live signals: decide as each new hour becomes public, with the backtest's own function and parameters."""

from __future__ import annotations

import hashlib
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.functions import contract
from peakledger.functions.events import TOPIC
from peakledger.operators import live, merge
from peakledger.streaming import topics
from peakledger.streaming.warehouse import Warehouse, utc_now

REPORT = "ICIDemand"
MARKET = timedelta(hours=5)  # fixed value: market time is five hours behind UTC


class Evaluator:
    """Adds readings to the history (versions resolved), and writes decisions for hours that arrived live and lately.

    The history is a demand table of its own, so a replay rebuilds it and announces nothing again.
    """

    def __init__(self, history: Warehouse, params: DataFrame, topic_root: str, name: str = "signals", now=utc_now, attempt: str = "first"):
        self.history, self.params, self.topic_root, self.name, self.now, self.attempt = history, params, topic_root, name, now, attempt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        events = contract.decode(topics.judged(batch)).where(F.col("report") == REPORT).persist()
        try:
            self.history.write_batch(events)
            self._evaluate(events, batch_id)
        finally:
            events.unpersist()

    def _evaluate(self, events: DataFrame, batch_id: int) -> None:
        now = F.lit(self.now()).cast("timestamp_ntz")
        recent = live.recent_live(events, now)
        lo, hi = merge.day_bounds(recent)
        if lo is None:
            return
        # A decision looks back to the start of its base period, one day further for the day-ahead estimate. Base periods change at
        # midnight market time, five hours after the UTC date does.
        earliest = lo - MARKET
        base = date(earliest.year if earliest.month >= 5 else earliest.year - 1, 5, 1)
        stored = self.history.current(base - timedelta(days=1), date(hi.year + 1, 1, 1))
        zones = recent.select("zone").distinct()
        points = (stored.join(zones, "zone", "left_semi").where(F.col("report") == REPORT)
                  .select("zone", "interval_start", F.col("value_mw").alias("mw")))
        # Only decisions the table does not hold are announced, so neither a second try nor a replay announces one again.
        decided = live.evaluate(recent.select("zone", "interval_start"), points, self.params, now).persist()
        rows = self.history.unannounced(decided).persist()
        try:
            if not rows.isEmpty():
                topics.send(topics.signal_messages(rows), f"{self.topic_root}/{self.name}", batch=f"{self.attempt}-{batch_id}")
                self.history.write_signals(rows)
        finally:
            rows.unpersist()
            decided.unpersist()


def run(spark: SparkSession, topic_root: str, history: Warehouse, params: DataFrame, checkpoint: str, signal_root: str,
        name: str = "signals", now=utc_now, always: bool = False, files_per_batch: int | None = None, kafka: dict | None = None):
    attempt = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]  # another checkpoint's messages stay
    source = topics.stream(spark, topic_root, [TOPIC[REPORT]], files_per_batch, kafka)
    trigger = {"processingTime": "10 seconds"} if always else {"availableNow": True}
    return (source.writeStream.queryName(name).foreachBatch(Evaluator(history, params, signal_root, name, now, attempt))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
