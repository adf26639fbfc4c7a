"""Freshness, latency, lag, alerts and load-test summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from peakledger.functions import clock
from peakledger.operators import selection

# Alert thresholds and their look-back, in minutes.
STALE_SECONDS, STALE_MINUTES = 90 * 60, 10
LAG_EVENTS, LAG_MINUTES = 2000, 5
FAILED_FILES, FAILED_MINUTES = 3, 15
SILENCE_MINUTES = 20
P95 = 0.95


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """report, outcome -> count, for any frame with those columns."""
    return outcomes.groupBy("report", "outcome").agg(F.count(F.lit(1)).alias("count"))


def latency_percentiles(events: DataFrame, seen_at: str = "ingested_at") -> DataFrame:
    """Per report: n, p50, p95, max of the whole seconds from publishing to ``seen_at``; live events only.

    Positions are floor(n/2) and floor(0.95 n) of the sorted list, counted from 0. Rounding keeps order, so rounding first
    gives the same answer.
    """
    seconds = F.rint(clock.seconds_between(F.col("published_at"), F.col(seen_at)).cast("double")).cast("bigint")
    live = events.where(F.col("reason") == "live").select("report", seconds.alias("seconds"))
    n = F.col("n")
    return selection.nth_values(live, ["report"], "seconds", {
        "latency_p50_s": F.floor(n / 2), "latency_p95_s": F.floor(n * F.lit(P95)), "latency_max_s": n - 1})


def data_age(events: DataFrame, as_of: Column) -> DataFrame:
    """Seconds since the newest publication, per report."""
    newest = events.groupBy("report").agg(F.max("published_at").alias("newest_published"))
    return newest.withColumn("data_age_s", clock.seconds_between(F.col("newest_published"), as_of).cast("double"))


def lag_of(high: Column, position: Column, committed: Column, low: Column) -> Column:
    """Unread events. A negative offset means unknown; then the committed one counts, and failing that the low mark."""
    known = F.coalesce(F.when(position >= 0, position), F.when(committed >= 0, committed), low)
    return F.greatest(F.lit(0), high - known)


def partition_lag(offsets: DataFrame) -> DataFrame:
    """topic, partition, lag; plus a total per topic and over all, named 'all'."""
    lags = offsets.select("topic", F.col("partition").cast("string").alias("partition"), lag_of(
        F.col("high"), F.col("position"), F.col("committed"), F.col("low")).alias("lag"))
    name = lambda c: F.when(F.grouping(c) == 1, "all").otherwise(F.col(c))
    totals = lags.rollup("topic", "partition").agg(
        F.sum("lag").alias("lag"), name("topic").alias("t"), name("partition").alias("p"))
    return totals.select(F.col("t").alias("topic"), F.col("p").alias("partition"), "lag")


def _minute() -> Column:
    return clock.minute_of(F.col("ts")).alias("minute")


def _looking_back(per_minute: DataFrame, width: int, fold: Column) -> DataFrame:
    """Value at every tick: the fold of the ``width`` minutes that end with it. One row per service and minute comes in."""
    ticks = F.sequence(F.col("minute"), F.col("minute") + clock.minutes(width - 1), F.expr("INTERVAL 1 MINUTE"))
    return per_minute.withColumn("tick", F.explode(ticks)).groupBy("service", "tick").agg(fold.alias("observed"))


def stale_alerts(ages: DataFrame, threshold: float = STALE_SECONDS, width: int = STALE_MINUTES) -> DataFrame:
    """Highest data age of the last minutes above the threshold. ``ages``: service, ts, value."""
    per_minute = ages.groupBy("service", _minute()).agg(F.max("value").alias("value"))
    return _looking_back(per_minute, width, F.max("value")).where(F.col("observed") > threshold)


def lag_alerts(lags: DataFrame, threshold: float = LAG_EVENTS, width: int = LAG_MINUTES) -> DataFrame:
    """Total lag above the threshold in every one of the last minutes. ``lags``: service, partition, ts, value."""
    latest = lags.groupBy("service", "partition", _minute()).agg(
        F.max_by("value", F.struct("ts", "value")).cast("decimal(18,2)").alias("value"))
    per_minute = latest.groupBy("service", "minute").agg(F.sum("value").alias("value"))
    return _looking_back(per_minute, width, F.min("value").cast("double")).where(F.col("observed") > threshold)


def failure_alerts(failures: DataFrame, threshold: float = FAILED_FILES, width: int = FAILED_MINUTES) -> DataFrame:
    """More failed files than allowed in the last minutes. ``failures``: service, ts, one row per failure."""
    per_minute = failures.groupBy("service", _minute()).agg(F.count(F.lit(1)).alias("value"))
    return _looking_back(per_minute, width, F.sum("value").cast("double")).where(F.col("observed") > threshold)


def silences(samples: DataFrame, limit_minutes: int = SILENCE_MINUTES, as_of: Column | None = None) -> DataFrame:
    """Stretches without data longer than the limit: service, silent_from, silent_until, seconds, still_silent.

    With ``as_of``, a silence that goes on at that instant is reported too, up to it. Samples are first reduced to the first and last of each block half as long as the limit; no silence fits inside one.
    """
    width = limit_minutes * 30
    block = F.floor(clock.seconds_between(F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")) / width)
    blocks = samples.groupBy("service", block.alias("block")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    following = F.lead("first").over(Window.partitionBy("service").orderBy("block"))
    seconds = clock.seconds_between(F.col("last"), F.col("next"))
    ends = blocks.withColumn("_back", following).withColumn("next", F.coalesce("_back", F.lit(None).cast("timestamp_ntz") if as_of is None else as_of))
    return (ends.where(F.col("next") > F.col("last") + clock.minutes(limit_minutes))
            .select("service", F.col("last").alias("silent_from"), F.col("next").alias("silent_until"),
                    seconds.cast("double").alias("seconds"), F.col("_back").isNull().alias("still_silent")))


def health_rollup(samples: DataFrame) -> DataFrame:
    """Dashboard rows: per service and hour, samples, highest, total, rate per second, and the exact 95th percentile.

    The percentile is that of the values as they are, taken by counting them in blocks, so a crowded hour is never sorted in one
    place. The total is summed in millionths, which makes it the same in any order.
    """
    rows = samples.select("service", clock.hour_of(F.col("ts")).alias("period"), "value")
    sums = rows.groupBy("service", "period").agg(
        F.count(F.lit(1)).alias("samples"), F.max("value").alias("highest"),
        F.sum(F.col("value").cast("decimal(24,6)")).cast("double").alias("total"))
    high = selection.nth_values(rows, ["service", "period"], "value", {"p95": F.floor(F.col("n") * F.lit(P95))}, block=0.25)
    return (sums.join(high.select("service", "period", "p95"), ["service", "period"])
            .withColumn("per_second", F.col("samples") / 3600.0))


def drain_summary(samples: DataFrame) -> DataFrame:
    """Per run: peak lag, first time drained, rate, most replicas, first scaled up, first back at one.

    ``samples``: run, elapsed_s, replicas, lag. Two passes: facts per run, then the quiet samples after them.
    """
    t, replicas = F.col("elapsed_s"), F.col("replicas")
    facts = samples.groupBy("run").agg(
        F.max("lag").alias("peak_lag_events"),
        F.min(F.when((F.col("lag") == 0) & (t > 0), t)).alias("drain_seconds"),
        F.max("replicas").alias("max_replicas"),
        F.min(F.when(replicas >= 2, t)).alias("first_scaled_up_at_seconds"),
        F.min_by("elapsed_s", F.struct(-replicas, t)).alias("_peak_at"))
    scaled = facts.where(F.col("drain_seconds").isNotNull() & F.col("first_scaled_up_at_seconds").isNotNull())
    quiet = samples.where(replicas <= 1).select("run", "elapsed_s").join(scaled.select("run", "drain_seconds", "_peak_at"), "run")
    back = (quiet.where((t > F.col("_peak_at")) & (t >= F.col("drain_seconds")))
            .groupBy("run").agg(F.min("elapsed_s").alias("back_to_one_replica_at_seconds")))
    rate = F.bround(F.col("peak_lag_events") / F.col("drain_seconds"), 1)
    return facts.join(back, "run", "left").select(
        "run", "peak_lag_events", "drain_seconds", rate.alias("events_per_second"), "max_replicas",
        "first_scaled_up_at_seconds", "back_to_one_replica_at_seconds")


def publication_lag(files: DataFrame, limit_minutes: int = 20) -> DataFrame:
    """Per report: n, median minutes from the end of the interval to publication, and the share within the limit.

    ``files``: report, minutes (whole).
    """
    middle = selection.median(files, ["report"], "minutes", "median_minutes")
    share = files.groupBy("report").agg((F.count_if(F.col("minutes") <= limit_minutes) / F.count(F.lit(1))).alias("share_within"))
    return middle.join(share, "report")
