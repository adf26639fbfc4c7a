"""The alert rules on a stream: event-time windows that are final once the watermark has passed them.

Instants come and go as UTC in ``timestamp_ntz``; in between they are epoch instants, so the session time zone plays no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.functions import clock
from peakledger.operators import metrics, sketches

#: Samples may come this much after later ones and still count.
LATE = "2 minutes"
EPOCH = "1970-01-01"


def _instant(ts: Column) -> Column:
    return F.timestamp_micros((clock.seconds_between(F.lit(EPOCH).cast("timestamp_ntz"), ts) * 1_000_000).cast("bigint"))


def _plain(instant: Column) -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz") + F.expr("INTERVAL '1' SECOND") * (F.unix_micros(instant) / 1_000_000)


def _timed(samples: DataFrame, late: str) -> DataFrame:
    return samples.withColumn("at", _instant(F.col("ts"))).withWatermark("at", late)


def _at_ticks(windowed: DataFrame, threshold: float) -> DataFrame:
    """A tick is the last minute of its window, as in the batch rules."""
    tick = _plain(F.col("w.end")) - clock.minutes(1)
    return windowed.where(F.col("observed") > threshold).select("service", tick.alias("tick"), "observed")


def _sliding(instant: Column, width: int) -> Column:
    return F.window(instant, f"{width} minutes", "1 minute").alias("w")


def stale_alerts(ages: DataFrame, threshold: float = metrics.STALE_SECONDS, width: int = metrics.STALE_MINUTES, late: str = LATE) -> DataFrame:
    """Streaming twin of ``metrics.stale_alerts``."""
    return _at_ticks(_timed(ages, late).groupBy("service", _sliding(F.col("at"), width)).agg(F.max("value").alias("observed")), threshold)


def failure_alerts(failures: DataFrame, threshold: float = metrics.FAILED_FILES, width: int = metrics.FAILED_MINUTES, late: str = LATE) -> DataFrame:
    """Streaming twin of ``metrics.failure_alerts``."""
    counted = _timed(failures, late).groupBy("service", _sliding(F.col("at"), width)).agg(F.count(F.lit(1)).cast("double").alias("observed"))
    return _at_ticks(counted, threshold)


def lag_alerts(lags: DataFrame, threshold: float = metrics.LAG_EVENTS, width: int = metrics.LAG_MINUTES, late: str = LATE) -> DataFrame:
    """Streaming twin of ``metrics.lag_alerts``: last value of each partition's minute, sum per minute, least over the window.

    Three aggregates in a row, each final before the next one counts it.
    """
    minute = F.window("at", "1 minute").alias("m")
    latest = _timed(lags, late).groupBy("service", "partition", minute).agg(F.max_by("value", F.struct("ts", "value")).cast("decimal(18,2)").alias("value"))
    per_minute = latest.groupBy("service", F.window(F.window_time("m"), "1 minute").alias("m")).agg(F.sum("value").alias("value"))
    return _at_ticks(per_minute.groupBy("service", _sliding(F.window_time("m"), width)).agg(F.min("value").cast("double").alias("observed")), threshold)


def minute_sketches(samples: DataFrame, late: str = LATE) -> DataFrame:
    """Streaming twin of ``sketches.per_minute``: a minute's row once the watermark has passed it, to be stored and rolled up."""
    windowed = _timed(samples, late).groupBy("service", F.window("at", "1 minute").alias("w")).agg(*sketches.folded())
    return windowed.select("service", _plain(F.col("w.start")).alias("period"), "samples", "highest", "total", "sketch")
