"""The peak-risk rule as one DataFrame function, shared by the backtest, the live evaluator and the replay.

A day counts toward the bar once it is over at the decision time. That last usable day depends only on the candidate's
hour and the variant, so the as-of look-up is an equi-join on (zone, base year, effective day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.functions import clock
from peakledger.operators import series

# Fixed texts; the survey's flag kinds are named after them.
OUTSIDE = "outside the plausible peak window"
NO_DATA = "no demand data to estimate from"
WARM_UP = "warm-up: fewer than 5 complete days in this base period"


def with_params(df: DataFrame, margins: dict[str, float], months: list[int], he_min: int, he_max: int) -> DataFrame:
    """Attach one fixed window and a margin per variant."""
    pairs = [x for v, m in margins.items() for x in (F.lit(v), F.lit(float(m)))]
    return (df.withColumn("margin", F.create_map(*pairs)[F.col("variant")])
            .withColumn("months", F.array(*[F.lit(m) for m in months]))
            .withColumn("he_min", F.lit(he_min)).withColumn("he_max", F.lit(he_max)))


def every_hour(points: DataFrame, variants=clock.VARIANTS, carry: list[str] | None = None) -> DataFrame:
    """zone, candidate_hour, variant and the carried columns: each hour once per variant."""
    return points.select("zone", F.col("interval_start").alias("candidate_hour"), *(carry or []),
                         F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant"))


def live_candidates(newest: DataFrame, window: DataFrame | None = None) -> DataFrame:
    """What becomes decidable when the hour at ``interval_start`` turns public.

    ``newest``: zone, interval_start, months, he_min, he_max and any other columns, which are carried along.
    """
    start = F.col("interval_start")
    staleness = [F.struct(F.lit(v).alias("variant"), (start + clock.hours(n)).alias("candidate_hour"))
                 for v, n in clock.STALENESS.items()]
    tomorrow = clock.est_midnight(F.date_add(clock.est_day(start), 1))
    next_day = F.transform(
        F.sequence(F.col("he_min"), F.col("he_max")),
        lambda he: F.struct(F.lit("day_ahead").alias("variant"), (tomorrow + clock.hours(he - 1)).alias("candidate_hour")))
    in_season = F.filter(next_day, lambda c: clock.in_window(
        c["candidate_hour"], F.col("months"), F.col("he_min"), F.col("he_max")))
    day_ahead = F.when(clock.hour_ending(start) == 24, in_season)
    both = F.concat(F.array(*staleness), F.coalesce(day_ahead, F.slice(next_day, 1, 0)))
    kept = [c for c in newest.columns if c != "interval_start"]
    return newest.select(start.alias("latest_start"), *kept, F.explode(both).alias("c")).select(
        "latest_start", *kept, "c.*")


def estimates(candidates: DataFrame, points: DataFrame, daily: DataFrame) -> DataFrame:
    """Adds ``estimate``: an exact look-up, never the last known value, so a missing hour or day gives null.

    Both keys are set on every row, also where the variant uses only one, so that no null keys pile up in one task.
    """
    variant, start = F.col("variant"), F.col("candidate_hour")
    hour = start
    for name, age in clock.STALENESS.items():
        hour = F.when(variant == name, start - clock.hours(age)).otherwise(hour)
    by_hour = points.select("zone", F.col("interval_start").alias("_hour"), F.col("mw").alias("_mw"))
    by_day = daily.select("zone", F.col("day").alias("_day"), F.col("peak").alias("_peak"))
    return (candidates.withColumn("_hour", hour).withColumn("_day", F.date_sub(clock.est_day(start), 1))
            .join(by_hour, ["zone", "_hour"], "left").join(by_day, ["zone", "_day"], "left")
            .withColumn("estimate", F.when(variant == "day_ahead", F.col("_peak")).otherwise(F.col("_mw")))
            .drop("_hour", "_day", "_mw", "_peak"))


def known_bars(candidates: DataFrame, bar: DataFrame) -> DataFrame:
    """Adds ``bar`` as known at the decision time, within the candidate's own base period."""
    complete_by = F.col("decided_at") - clock.minutes(clock.LAG_MINUTES)
    return (candidates.withColumn("base_year", clock.base_year(clock.est_day(F.col("candidate_hour"))))
            .withColumn("eff_day", clock.est_day(complete_by))
            .join(bar, ["zone", "base_year", "eff_day"], "left").drop("eff_day"))


def flagged(estimate: Column, margin: Column, bar: Column) -> Column:
    """Kept in this form: dividing instead would move values that sit exactly on the bar."""
    return estimate >= margin * bar


def reason_text() -> Column:
    mw = lambda c: F.format_number(F.col(c), 0)
    margin = F.format_string("%.2f", "margin")
    reaches = F.concat(F.lit("estimate "), mw("estimate"), F.lit(" MW reaches "), margin, F.lit(" x "), mw("bar"),
                       F.lit(" MW (5th-highest daily peak so far)"))
    below = F.concat(F.lit("estimate "), mw("estimate"), F.lit(" MW is below "), margin, F.lit(" x "), mw("bar"), F.lit(" MW"))
    return (F.when(~F.col("in_window"), OUTSIDE).when(F.col("estimate").isNull(), NO_DATA)
            .when(F.col("bar").isNull(), WARM_UP).when(F.col("risk"), reaches).otherwise(below))


def reason_kind() -> Column:
    return (F.when(~F.col("in_window"), "outside").when(F.col("estimate").isNull(), "no_data")
            .when(F.col("bar").isNull(), "warm_up").when(F.col("risk"), "reaches").otherwise("below"))


def evidence(candidates: DataFrame, points: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """``candidates``: zone, variant, candidate_hour, months, he_min, he_max, and columns to carry along.

    Adds decided_at, in_window, base_year, estimate, bar. The order of the tests is: outside the window, nothing to estimate
    from, no bar yet. Filter on ``in_window`` where outside hours are not needed: the filter moves below the joins.
    """
    daily = series.daily_peaks(points) if daily is None else daily
    start = F.col("candidate_hour")
    timed = (candidates.withColumn("decided_at", clock.decision_time(F.col("variant"), start))
             .withColumn("in_window", clock.in_window(start, F.col("months"), F.col("he_min"), F.col("he_max"))))
    return (known_bars(estimates(timed, points, daily), series.bars(daily))
            .withColumn("estimate", F.when(F.col("in_window"), F.col("estimate")))
            .withColumn("bar", F.when(F.col("estimate").isNotNull(), F.col("bar"))))


def decide(candidates: DataFrame, points: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """As ``evidence``, for candidates that also carry ``margin``; adds ``risk``."""
    hit = flagged(F.col("estimate"), F.col("margin"), F.col("bar"))
    return evidence(candidates, points, daily).withColumn("risk", F.coalesce(hit, F.lit(False)))


def signal_rows(decisions: DataFrame, evaluated_at: Column) -> DataFrame:
    """Decisions in the shape of the signals table."""
    return decisions.select(
        "zone", "variant", "candidate_hour", "decided_at", "risk", reason_text().alias("reason"),
        F.col("estimate").alias("estimate_mw"), F.col("bar").alias("bar_mw"), "margin",
        clock.notice_hours(F.col("candidate_hour"), F.col("decided_at")).alias("notice_hours"),
        evaluated_at.alias("evaluated_at"))
