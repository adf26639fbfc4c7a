"""Walk-forward evaluation: window and margins come from the training years only, the hold-out is scored once with them.

All margins of the grid are scored in one pass over the in-window hours, which stay one row per hour and variant: an hour is counted
at the largest margin that flags it, and what a margin flags is the sum of the counts from it on. Tuning reads the small grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from peakledger.functions import clock, names
from peakledger.functions.events import ZONE
from peakledger.operators import rule, series
from peakledger.sources import files as landed, reports

# Fixed values of the evaluation.
GRID = [round(0.80 + 0.01 * i, 2) for i in range(21)]  # margins 0.80 .. 1.00
TARGET = 8                                             # training peaks to catch
PEAKS = 5                                              # peaks per base period


def truth(daily: DataFrame, tracker: DataFrame | None = None, official_years: list[int] | None = None) -> DataFrame:
    """zone, base_year, peak_hour: the peaks to catch.

    Taken from the official tracker for ``official_years`` (its first five by rank), else derived from the series.
    """
    derived = series.top_peaks(daily, PEAKS).select("zone", "base_year", "peak_hour")
    if tracker is None:
        return derived
    official = (tracker.where(F.col("rank") <= PEAKS)
                .withColumn("base_year", clock.base_year(F.col("delivery_date")))
                .where(F.col("base_year").isin(official_years)).select("zone", "base_year", F.col("interval_start").alias("peak_hour")))
    return derived.where(~F.col("base_year").isin(official_years)).unionByName(official)


def derive_window(peaks: DataFrame, train: list[int]) -> DataFrame:
    """zone, months, he_min, he_max: seen in the training peaks, one hour wider on each side."""
    he = clock.hour_ending(F.col("peak_hour"))
    seen = peaks.where(F.col("base_year").isin(train))
    return seen.groupBy("zone").agg(
        F.sort_array(F.collect_set(F.month(clock.est(F.col("peak_hour"))))).alias("months"),
        F.greatest(F.lit(1), F.min(he) - 1).alias("he_min"), F.least(F.lit(24), F.max(he) + 1).alias("he_max"))


def in_window_hours(points: DataFrame, window: DataFrame, years: list[int]) -> DataFrame:
    """Hours of the base periods that lie inside the zone's window, with the window's columns."""
    start = F.col("interval_start")
    return (points.withColumn("base_year", clock.base_year(clock.est_day(start))).where(F.col("base_year").isin(years))
            .join(window, "zone").where(clock.in_window(start, F.col("months"), F.col("he_min"), F.col("he_max"))))


def margin_level(estimate: Column, bar: Column) -> Column:
    """How many margins of the grid, from the smallest, flag the hour: a larger margin flags no hour that a smaller one does not."""
    return sum((F.coalesce(rule.flagged(estimate, F.lit(m), bar), F.lit(False)).cast("int") for m in GRID), F.lit(0))


def _histogram(level: str) -> Column:
    """Rows at each level from 1 to the length of the grid, as an aggregate."""
    return F.array(*[F.count_if(F.col(level) == k) for k in range(1, len(GRID) + 1)])


def _at_least(histogram: str) -> Column:
    """Rows at the level of ``_place`` or above: a suffix sum."""
    above = F.slice(histogram, F.col("_place"), F.lit(len(GRID)))
    return F.coalesce(F.aggregate(above, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"))


def _median(values: str) -> Column:
    """Of a sorted list; null for an empty one."""
    n = F.size(values)
    low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def score_grid(points: DataFrame, peaks: DataFrame, window: DataFrame, years: list[int],
               variants=clock.VARIANTS, daily: DataFrame | None = None) -> DataFrame:
    """One row per zone, base_year, variant and margin, zero rows included."""
    daily = series.daily_peaks(points) if daily is None else daily
    inside = in_window_hours(points, window, years)
    hours = inside.groupBy("zone", "base_year").agg(F.count(F.lit(1)).alias("in_window_hours"))
    known = peaks.where(F.col("base_year").isin(years)).join(window, "zone")
    peak_in = clock.in_window(F.col("peak_hour"), F.col("months"), F.col("he_min"), F.col("he_max"))
    targets = known.groupBy("zone", "base_year").agg(
        F.count(F.lit(1)).alias("peaks"), F.count_if(peak_in).alias("peaks_in_window"))
    facts = targets.join(hours, ["zone", "base_year"], "left").na.fill(0, ["in_window_hours"])
    cells = (facts.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in variants])))
             .withColumn("margin", F.explode(F.array(*[F.lit(m) for m in GRID]))))

    decided = rule.evidence(rule.every_hour(inside, variants, carry=["months", "he_min", "he_max"]), points, daily)
    marks = peaks.select("zone", F.col("peak_hour").alias("candidate_hour"), F.lit(True).alias("is_peak"))
    lead = clock.seconds_between(F.col("decided_at"), F.col("candidate_hour")).cast("double") / 3600
    key = ["zone", "base_year", "variant"]
    reached = (decided.withColumn("level", margin_level(F.col("estimate"), F.col("bar"))).where("level > 0")
               .join(marks, ["zone", "candidate_hour"], "left").withColumn("lead", lead))
    hours_at = reached.groupBy(*key).agg(_histogram("level").alias("hours_at"), F.collect_list(
        F.when(F.col("is_peak"), F.struct("level", "lead"))).alias("peaks_at"))  # at most PEAKS of them a base period
    days_at = (reached.groupBy(*key, clock.est_day(F.col("candidate_hour")).alias("day")).agg(F.max("level").alias("level"))
               .groupBy(*key).agg(_histogram("level").alias("days_at")))
    place = F.array_position(F.array(*[F.lit(m) for m in GRID]), F.col("margin")).cast("int")
    out = cells.join(hours_at, key, "left").join(days_at, key, "left").withColumn("_place", place)
    caught = F.filter("peaks_at", lambda p: p["level"] >= F.col("_place"))
    out = out.withColumn("_leads", F.sort_array(F.transform(caught, lambda p: p["lead"])))
    out = out.withColumns({
        "captured": F.coalesce(F.size("_leads"), F.lit(0)).cast("bigint"), "alert_hours": _at_least("hours_at"), "alert_days": _at_least("days_at"),
        "median_lead_hours": F.bround(_median("_leads"), 1)}).drop("hours_at", "days_at", "peaks_at", "_place", "_leads")
    chance = F.when(F.col("in_window_hours") > 0, F.bround(
        F.col("peaks_in_window") * F.col("alert_hours") / F.col("in_window_hours"), 2)).otherwise(F.lit(0.0))
    return out.withColumn("chance_captured", chance)


def frontier(grid: DataFrame, train: list[int]) -> DataFrame:
    """Per zone, variant and margin: peaks caught and alert hours over the training years."""
    return (grid.where(F.col("base_year").isin(train)).groupBy("zone", "variant", "margin")
            .agg(F.sum("captured").alias("captured"), F.sum("alert_hours").alias("alert_hours")))


def choose_margins(front: DataFrame, target: int = TARGET) -> DataFrame:
    """zone, variant, margin. Among margins that catch the target: fewest alert hours, then the largest margin. If none does:
    most caught, then fewest alert hours, then the smallest margin."""
    good = F.col("captured") >= target
    order = [F.desc(good), F.asc(F.when(~good, -F.col("captured"))), F.asc("alert_hours"),
             F.asc(F.when(good, -F.col("margin")).otherwise(F.col("margin")))]
    rank = F.row_number().over(Window.partitionBy("zone", "variant").orderBy(*order))
    return front.withColumn("_rn", rank).where(F.col("_rn") == 1).select("zone", "variant", "margin")


def walk_forward(points: DataFrame, train: list[int], holdout: list[int], target: int = TARGET,
                 tracker: DataFrame | None = None, official_years: list[int] | None = None) -> dict[str, DataFrame]:
    """window, grid, frontier, margins, scores (chosen margin, every year with its part), totals (hold-out sums), missed."""
    daily = series.daily_peaks(points)
    peaks = truth(daily, tracker, official_years)
    window = derive_window(peaks, train)
    grid = score_grid(points, peaks, window, train + holdout, daily=daily)
    front = frontier(grid, train)
    margins = choose_margins(front, target)
    part = F.when(F.col("base_year").isin(train), "train").otherwise("holdout")
    scores = grid.join(margins, ["zone", "variant", "margin"], "left_semi").withColumn("part", part)
    totals = scores.where(F.col("part") == "holdout").groupBy("zone", "variant", "margin").agg(
        F.sum("captured").alias("captured"), F.sum("peaks").alias("peaks"), F.sum("alert_hours").alias("alert_hours"),
        F.sum(F.col("chance_captured").cast("decimal(18,2)")).cast("double").alias("chance_captured"))
    missed = missed_peaks(points, peaks, window, margins, train + holdout, daily)
    return {"window": window, "grid": grid, "frontier": front, "margins": margins, "scores": scores, "totals": totals,
            "missed": missed}


def missed_peaks(points: DataFrame, peaks: DataFrame, window: DataFrame, margins: DataFrame, years: list[int],
                 daily: DataFrame | None = None) -> DataFrame:
    """zone, base_year, variant, peak_hour for every peak the chosen margin does not flag."""
    asked = (peaks.where(F.col("base_year").isin(years)).join(window, "zone").join(margins, "zone")
             .withColumnRenamed("peak_hour", "candidate_hour").drop("base_year"))
    return rule.decide(asked, points, daily).where(~F.col("risk")).select(
        "zone", "base_year", "variant", F.col("candidate_hour").alias("peak_hour"))


def params(result: dict[str, DataFrame]) -> DataFrame:
    """zone, variant, margin, months, he_min, he_max: what the live evaluator uses. The ceiling variant stays out."""
    return (result["margins"].where(F.col("variant").isin(*clock.LIVE_VARIANTS)).join(result["window"], "zone"))


def load(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(points, tracker) from root/ICIDemand/*.csv and root/ICIPeakTracker/*.xml; of several versions of an hour the newest counts."""
    texts = landed.read_folder(spark, root, wanted_only=False)
    good = reports.parse(texts.where(F.col("report") == "ICIDemand"), versioned=False).where(F.col("error").isNull())
    version = F.coalesce(names.version_of(F.col("name")), F.lit(0).cast("bigint"))
    hours = good.select(version.alias("version"), F.explode("rows").alias("r"))
    points = hours.groupBy(F.lit(ZONE).alias("zone"), F.col("r.interval_start").alias("interval_start")).agg(
        F.max_by("r.value_mw", "version").alias("mw"))
    tracker = reports.parse_tracker(texts.where(F.col("report") == "ICIPeakTracker")).where(F.col("error").isNull())
    return points, tracker.withColumn("zone", F.lit(ZONE))


def write_results(result: dict[str, DataFrame], root: str) -> None:
    """The result as tables under ``root``; the grid, which all of them read, is held while they are written."""
    cached = result["grid"].persist()
    try:
        for name in ("window", "frontier", "margins", "scores", "totals", "missed"):
            result[name].write.mode("overwrite").parquet(f"{root}/{name}")
        params(result).write.mode("overwrite").parquet(f"{root}/params")
    finally:
        cached.unpersist()


def read_params(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("zone string, variant string, margin double, months array<int>, he_min int, he_max int").parquet(
        f"{root}/params")
