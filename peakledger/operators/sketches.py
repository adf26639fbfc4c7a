"""Health figures that add up: one small row per service and minute, rolled up to hours, and hours to days, without the samples.

The percentile comes from KLL sketches, which merge: a day made of its hours has the error of a sketch over all samples of the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.functions import clock
from peakledger.operators.metrics import P95

#: Size of a sketch, some 20 KB at most. At 1600 the rank of an estimate is off by about 0.2 % of the samples.
K = 1600
ROW = "service string, period timestamp_ntz, samples bigint, highest double, total decimal(38,6), sketch binary"


def folded() -> list[Column]:
    """The aggregates of one row: over ``value``."""
    return [F.count(F.lit(1)).alias("samples"), F.max("value").alias("highest"),
            F.sum(F.col("value").cast("decimal(24,6)")).cast("decimal(38,6)").alias("total"), F.kll_sketch_agg_double("value", F.lit(K)).alias("sketch")]


def per_minute(samples: DataFrame) -> DataFrame:
    """service, period (the minute) and its figures. ``samples``: service, ts, value; null values count as samples only."""
    return samples.groupBy("service", clock.minute_of(F.col("ts")).alias("period")).agg(*folded())


def rolled(rows: DataFrame, period: Column) -> DataFrame:
    """Rows of a longer period from those of a shorter one; ``period`` names the longer one, worked out from the shorter.

    Sketches are merged on the map side too, so a task keeps one per service and period. A minute may come in several rows.
    """
    return rows.select("service", period.alias("period"), "samples", "highest", "total", "sketch").groupBy("service", "period").agg(
        F.sum("samples").alias("samples"), F.max("highest").alias("highest"), F.sum("total").cast("decimal(38,6)").alias("total"),
        F.kll_merge_agg_double("sketch", F.lit(K)).alias("sketch"))


def hours(rows: DataFrame) -> DataFrame:
    return rolled(rows, clock.hour_of(F.col("period")))


def days(rows: DataFrame) -> DataFrame:
    """UTC days."""
    return rolled(rows, F.col("period").cast("date").cast("timestamp_ntz"))


def quantile(rank: float) -> Column:
    """Value at a rank between 0 and 1; null for a sketch of no values."""
    filled = F.kll_sketch_get_n_double("sketch") > 0
    return F.when(filled, F.kll_sketch_get_quantile_double("sketch", F.lit(rank)))


def figures(rows: DataFrame, seconds: int) -> DataFrame:
    """Dashboard rows of periods of ``seconds``: samples, highest, total, median, 95th percentile, rate."""
    return rows.select("service", "period", "samples", "highest", F.col("total").cast("double").alias("total"),
                       quantile(0.5).alias("p50"), quantile(P95).alias("p95"), (F.col("samples") / F.lit(float(seconds))).alias("per_second"))


def rank_bounds(samples: DataFrame, estimates: DataFrame, period: Column) -> DataFrame:
    """service, period, below, up_to: the exact shares of samples under, and not over, the estimate ``p95`` of their period.

    The estimate's rank lies between the two, so it is off by as much as 0.95 lies outside of them.
    """
    value = F.col("value")
    rows = samples.where(value.isNotNull()).select("service", period.alias("period"), "value")
    return (rows.join(estimates.select("service", "period", "p95"), ["service", "period"]).groupBy("service", "period").agg(
        (F.count_if(value < F.col("p95")) / F.count(F.lit(1))).alias("below"), (F.count_if(value <= F.col("p95")) / F.count(F.lit(1))).alias("up_to")))
