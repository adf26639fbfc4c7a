"""Whether readings sit at the positions they should, and whether hourly and fine values agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from peakledger.functions import clock


def positions(rows: DataFrame, group: list[str], position: str, full: int) -> DataFrame:
    """group, n, prefix (exactly 1..n once each), complete (exactly 1..full once each).

    Whole positions between 1 and n that are all different and n in number are 1..n.
    """
    per_value = rows.groupBy(*group, position).agg(F.count(F.lit(1)).alias("_copies"))
    out = per_value.groupBy(*group).agg(
        F.sum("_copies").alias("n"), F.count(F.lit(1)).alias("_distinct"), F.min(position).alias("_lo"), F.max(position).alias("_hi"))
    prefix = (F.col("n") == F.col("_distinct")) & (F.col("_lo") == 1) & (F.col("_hi") == F.col("n"))
    return (out.withColumn("prefix", prefix).withColumn("complete", prefix & (F.col("n") == full))
            .drop("_distinct", "_lo", "_hi"))


def hourly_against_fine(hourly: DataFrame, fine: DataFrame) -> DataFrame:
    """Per report: hours compared, hours whose hourly value is off the rounded mean of their five-minute values by over 0.5.

    ``hourly``: report, interval_start, value_mw. ``fine``: the same, one row per five minutes. Hours that one of the two
    series lacks are not compared.
    """
    hour = clock.hour_of(F.col("interval_start")).alias("interval_start")
    means = fine.groupBy("report", hour).agg(
        F.count(F.lit(1)).alias("slots"), F.sum(F.col("value_mw").cast("decimal(18,2)")).cast("double").alias("_total"))
    means = means.withColumn("mean_mw", F.rint(F.col("_total") / F.col("slots")))
    return means.join(hourly, ["report", "interval_start"]).groupBy("report").agg(
        F.count(F.lit(1)).alias("hours"), F.count_if(F.abs(F.col("mean_mw") - F.col("value_mw")) > 0.5).alias("apart"),
        F.max("slots").alias("most_slots"), F.max("mean_mw").alias("highest_mean"))
