"""Checks on the tables. Each returns one row with the number of violations: 0 is good."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from peakledger.functions import clock
from peakledger.functions.events import CURRENT_KEY

# Readings in a full day of five-minute data, and the slack around the historical range.
READINGS_PER_DAY = 288
LOW, HIGH = 0.8, 1.2


def _violations(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("violations"))


def duplicate_keys(current: DataFrame) -> DataFrame:
    return _violations(current.groupBy(*CURRENT_KEY).count().where(F.col("count") > 1))


def current_matches_raw(raw: DataFrame, current: DataFrame) -> DataFrame:
    """Every interval's current row holds the highest raw version. Copies in current are counted before the join."""
    newest = raw.groupBy(*CURRENT_KEY).agg(F.max("version").alias("_newest"))
    held = current.groupBy(*CURRENT_KEY, "version").agg(F.count(F.lit(1)).alias("_copies"))
    wrong = newest.join(held, CURRENT_KEY, "left").where(F.col("version").isNull() | (F.col("version") != F.col("_newest")))
    return wrong.agg(F.coalesce(F.sum(F.coalesce("_copies", F.lit(1))), F.lit(0)).cast("bigint").alias("violations"))


def values_in_range(current: DataFrame, history_report: str = "ICIDemand") -> DataFrame:
    """All reports are judged by one report's range; without any history every row is a violation."""
    seen = current.where(F.col("report") == history_report).agg(
        F.min("value_mw").alias("lo"), F.max("value_mw").alias("hi"))
    lo, hi = seen.select("lo").scalar(), seen.select("hi").scalar()
    bad = lo.isNull() | (F.col("value_mw") < LOW * lo) | (F.col("value_mw") > HIGH * hi)
    return _violations(current.where(bad))


def day_counts(readings: DataFrame, by: list[str]) -> DataFrame:
    return readings.groupBy(*by, clock.est_day(F.col("interval_start")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def incomplete_days(readings: DataFrame, by: list[str], expected: int) -> DataFrame:
    """Days with data on both sides that lack (or exceed) the expected number of readings."""
    days = day_counts(readings, by)
    before = days.select(*by, F.date_add("day", 1).alias("day"))
    after = days.select(*by, F.date_sub("day", 1).alias("day"))
    on = [*by, "day"]
    return days.where(F.col("n") != expected).join(before, on, "left_semi").join(after, on, "left_semi")


def reading_gaps(current: DataFrame, report: str = "RealtimeTotals", expected: int = READINGS_PER_DAY) -> DataFrame:
    """Per zone, since several zones may share the table."""
    return _violations(incomplete_days(current.where(F.col("report") == report), ["zone"], expected))


def report(raw: DataFrame, current: DataFrame) -> DataFrame:
    """check, violations: the whole suite in one frame."""
    checks = {"duplicate_keys": duplicate_keys(current), "current_matches_raw": current_matches_raw(raw, current),
              "values_in_range": values_in_range(current), "realtime_gaps": reading_gaps(current)}
    parts = [df.select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
