"""Hourly series: daily peaks, the as-of bar, exact look-ups, gaps.

``points``: zone, interval_start, mw - one row per zone and hour. A zone has at most 8,784 hours a year however many raw
rows there were, so per-zone work below is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from peakledger.functions import clock


def daily_peaks(points: DataFrame) -> DataFrame:
    """zone, day, peak, peak_hour (the earliest of equal hours), hours (readings that day)."""
    day = clock.est_day(F.col("interval_start"))
    return points.groupBy("zone", day.alias("day")).agg(
        F.max("mw").alias("peak"),
        # max_by would leave ties open: the first hour that reaches the peak is the smallest start among the largest mw
        F.min_by("interval_start", F.struct(-F.col("mw"), F.col("interval_start"))).alias("peak_hour"),
        F.count(F.lit(1)).alias("hours"))


def bars(daily: DataFrame, rank: int = 5) -> DataFrame:
    """zone, base_year, eff_day, bar: the rank-th highest daily peak of the base period over the days before ``eff_day``.

    A bar holds from the day after one with data until the next such day, so each day with data yields the rows up to then;
    days before the first have none. Null until ``rank`` days exist. At most 366 days per window partition, so sorting the
    list each day is cheap.
    """
    days = daily.select("zone", "day", "peak", clock.base_year(F.col("day")).alias("base_year"))
    period = Window.partitionBy("zone", "base_year").orderBy("day")
    best = F.sort_array(F.collect_list("peak").over(period.rowsBetween(Window.unboundedPreceding, Window.currentRow)), asc=False)
    first, last = F.date_add("day", 1), F.make_date(F.col("base_year") + 1, F.lit(4), F.lit(30))
    known = days.select("zone", "base_year", first.alias("_first"), F.coalesce(F.lead("day").over(period), last).alias("_last"),
                        F.try_element_at(best, F.lit(rank)).alias("bar"))
    return known.where(F.col("_first") <= F.col("_last")).select(
        "zone", "base_year", F.explode(F.sequence("_first", "_last")).alias("eff_day"), "bar")


def top_peaks(daily: DataFrame, n: int = 5) -> DataFrame:
    """The n highest days of each base period with their peak hour; equal peaks go to the earlier one."""
    year = clock.base_year(F.col("day"))
    order = Window.partitionBy("zone", "base_year").orderBy(F.desc("peak"), "peak_hour")
    return (daily.withColumn("base_year", year).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= n).select("zone", "base_year", "rank", "day", "peak_hour", "peak"))


def gaps(points: DataFrame, step_hours: int = 1) -> DataFrame:
    """Where the next reading is more than a step away: zone, gap_after, gap_until, missing."""
    following = F.lead("interval_start").over(Window.partitionBy("zone").orderBy("interval_start"))
    away = clock.seconds_between(F.col("interval_start"), F.col("next"))
    return (points.select("zone", "interval_start").withColumn("next", following)
            .where(F.col("next") > F.col("interval_start") + clock.hours(step_hours))
            .select("zone", F.col("interval_start").alias("gap_after"), F.col("next").alias("gap_until"),
                    (away / (3600 * step_hours) - 1).cast("bigint").alias("missing")))
