"""What was known when: values that get restated, read as of an instant.

A version holds from the instant it became known until the next version of its key does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from peakledger.functions import clock
from peakledger.operators import rule


def as_known(questions: DataFrame, versions: DataFrame, keys: list[str], value: str, asked_at: str = "asked_at",
             known_at: str = "known_at") -> DataFrame:
    """questions with ``value`` of the last version known by ``asked_at``, null where there was none; one row per question.

    Versions and questions of a key are put in one order of time and swept once, so no question meets more than its key's last
    version. Versions known at one instant count in order of ``version`` where they have it. Null keys are a key.
    """
    carried = F.struct(*questions.columns)
    rank = F.col("version") if "version" in versions.columns else F.lit(0)
    told = versions.select(*keys, F.col(known_at).alias("_at"), F.lit(False).alias("_asks"), rank.cast("bigint").alias("_rank"),
                           F.struct(F.col(value)).alias("_told"), F.lit(None).cast(questions.select(carried).schema[0].dataType).alias("_row"))
    asked = questions.select(*keys, F.col(asked_at).alias("_at"), F.lit(True).alias("_asks"), F.lit(None).cast("bigint").alias("_rank"),
                             F.lit(None).cast(told.schema["_told"].dataType).alias("_told"), carried.alias("_row"))
    sweep = Window.partitionBy(*keys).orderBy("_at", "_asks", "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = told.unionByName(asked).withColumn("_last", F.last("_told", ignorenulls=True).over(sweep)).where("_asks")
    return swept.select(*[F.col("_row")[c].alias(c) for c in questions.columns], F.col("_last")[value].alias(value))


def peak_versions(versions: DataFrame) -> DataFrame:
    """zone, day, known_at, until, peak: a day's highest hour as known from ``known_at`` on, before ``until`` where that is set.

    ``versions``: zone, interval_start, version, known_at, mw. Work grows with the versions of one day, whose hours the calendar bounds.
    """
    dated = versions.withColumn("day", clock.est_day(F.col("interval_start")))
    moments = dated.select("zone", "day", F.col("known_at").alias("at")).distinct()
    hours = (moments.join(dated, ["zone", "day"]).where(F.col("known_at") <= F.col("at"))
             .groupBy("zone", "day", "at", "interval_start").agg(F.max_by("mw", F.struct("known_at", "version")).alias("mw")))
    peaks = hours.groupBy("zone", "day", "at").agg(F.max("mw").alias("peak"))
    period = Window.partitionBy("zone", "day").orderBy("at")
    moved = peaks.withColumn("_before", F.lag("peak").over(period)).where(~F.col("peak").eqNullSafe(F.col("_before")))
    return moved.select("zone", "day", F.col("at").alias("known_at"), F.lead("at").over(period).alias("until"), "peak")


def bars_as_known(questions: DataFrame, peaks: DataFrame, rank: int = 5) -> DataFrame:
    """questions (zone, base_year, eff_day, decided_at) with ``bar``: the rank-th highest peak, as known then, of the base period's days
    before ``eff_day``; null where fewer days were known. ``peaks``: as ``peak_versions`` gives."""
    asked = questions.distinct()
    dated = peaks.withColumn("base_year", clock.base_year(F.col("day")))
    then = (F.col("day") < F.col("eff_day")) & (F.col("known_at") <= F.col("decided_at")) & (
        F.col("until").isNull() | (F.col("until") > F.col("decided_at")))
    met = asked.join(dated, ["zone", "base_year"]).where(then)
    # At most one peak per day of a base period, so at most 366 in a list.
    best = met.groupBy(*questions.columns).agg(F.sort_array(F.collect_list("peak"), asc=False).alias("_best"))
    return best.select(*questions.columns, F.try_element_at("_best", F.lit(rank)).alias("bar"))


def decide_as_known(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    """The rule with estimate and bar as they were known at ``decided_at``.

    ``candidates``: zone, variant, candidate_hour, margin, months, he_min, he_max; variants that decide before the hour. Only hours inside
    the window are decided about. Adds decided_at, base_year, estimate, bar, risk.
    """
    start, variant = F.col("candidate_hour"), F.col("variant")
    timed = (candidates.where(clock.in_window(start, F.col("months"), F.col("he_min"), F.col("he_max")))
             .withColumn("decided_at", clock.decision_time(variant, start))
             .withColumn("base_year", clock.base_year(clock.est_day(start)))
             .withColumn("eff_day", clock.est_day(F.col("decided_at") - clock.minutes(clock.LAG_MINUTES))))
    peaks = peak_versions(versions)
    hour = start
    for name, age in clock.STALENESS.items():
        hour = F.when(variant == name, start - clock.hours(age)).otherwise(hour)
    by_hour = as_known(timed.where(variant != "day_ahead").withColumn("interval_start", hour), versions, ["zone", "interval_start"], "mw", "decided_at")
    by_day = as_known(timed.where(variant == "day_ahead").withColumn("day", F.date_sub(clock.est_day(start), 1)), peaks, ["zone", "day"], "peak", "decided_at")
    guessed = by_hour.withColumnRenamed("mw", "estimate").drop("interval_start").unionByName(by_day.withColumnRenamed("peak", "estimate").drop("day"))
    keys = ["zone", "base_year", "eff_day", "decided_at"]
    barred = guessed.join(bars_as_known(timed.select(*keys), peaks), keys, "left").drop("eff_day")
    hit = rule.flagged(F.col("estimate"), F.col("margin"), F.col("bar"))
    return barred.withColumn("risk", F.coalesce(hit, F.lit(False)))
