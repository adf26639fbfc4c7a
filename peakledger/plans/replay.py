"""What the live rule would have said around a past day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from peakledger.functions import clock
from peakledger.operators import rule


def replay(points: DataFrame, newest: DataFrame, days: DataFrame) -> DataFrame:
    """Flags raised as the hours of each zone's day and the day before became public.

    ``newest``: zone, interval_start, months, he_min, he_max, margins (map variant -> margin). ``days``: zone, day.
    """
    since = clock.est_midnight(F.date_sub("day", 1))
    until = clock.est_midnight(F.date_add("day", 1))
    around = newest.join(days, "zone").where((F.col("interval_start") >= since) & (F.col("interval_start") < until))
    candidates = rule.live_candidates(around).withColumn("margin", F.col("margins")[F.col("variant")])
    return rule.decide(candidates, points).where(F.col("in_window") & F.col("risk"))
