"""Walk-forward evaluation on the demand feed: all its base years, the last two held out."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import clock
from peakledger.operators import series
from peakledger.plans import backtest
from peakledger.plans.catalog.base import BARS, DAILY, HOURS, ratio_sql, register
from peakledger.plans.catalog.signals import DECISION, MARKET, hourly
from peakledger.sources.feeds import demand_hours

CATCH = 4  # peaks to catch for each training year, of five
TRAINED = "base_year <= (SELECT hi - 2 FROM span)"

TRUTH = """
span AS (SELECT min(year(day - INTERVAL 4 MONTH)) AS lo, max(year(day - INTERVAL 4 MONTH)) AS hi FROM daily),
truth AS (
  SELECT zone, year(day - INTERVAL 4 MONTH) AS base_year, peak_hour, peak, day,
         row_number() OVER (PARTITION BY zone, year(day - INTERVAL 4 MONTH) ORDER BY peak DESC, peak_hour) AS rank
  FROM daily QUALIFY rank <= 5)"""
WINDOW = f"""
win AS (
  SELECT zone, list_sort(list(DISTINCT month(peak_hour {MARKET}))) AS months,
         greatest(1, min(hour(peak_hour {MARKET}) + 1) - 1) AS he_min, least(24, max(hour(peak_hour {MARKET}) + 1) + 1) AS he_max
  FROM truth WHERE {TRAINED} GROUP BY 1)"""


def inside_sql(column):
    return f"(list_contains(months, month({column} {MARKET})) AND hour({column} {MARKET}) + 1 BETWEEN he_min AND he_max)"


# Margins as whole hundredths divided by 100: the same doubles as the rounded grid.
GRID = f"""
inside AS (
  SELECT p.zone, interval_start AS candidate_hour, year(CAST(interval_start {MARKET} AS DATE) - INTERVAL 4 MONTH) AS base_year
  FROM points p JOIN win USING (zone) WHERE {inside_sql('interval_start')}),
timed AS (
  SELECT *, {DECISION} AS decided_at
  FROM inside, (VALUES ('oracle'), ('persist2'), ('persist4'), ('day_ahead')) v(variant)),
known AS (
  SELECT t.*, CASE WHEN variant = 'day_ahead' THEN d.peak ELSE p.mw END AS estimate, b.bar
  FROM timed t
  LEFT JOIN points p ON p.zone = t.zone AND p.interval_start = t.candidate_hour
       - CASE variant WHEN 'persist2' THEN INTERVAL 2 HOUR WHEN 'persist4' THEN INTERVAL 4 HOUR ELSE INTERVAL 0 HOUR END
  LEFT JOIN daily d ON d.zone = t.zone AND d.day = CAST(t.candidate_hour {MARKET} AS DATE) - 1
  LEFT JOIN bars b ON b.zone = t.zone AND b.base_year = t.base_year
       AND b.eff_day = CAST(t.decided_at - INTERVAL 15 MINUTE {MARKET} AS DATE)),
margins AS (SELECT m / 100.0::DOUBLE AS margin FROM range(80, 101) r(m)),
hits AS (
  SELECT k.*, margin, tr.peak_hour IS NOT NULL AS is_peak
  FROM known k JOIN margins ON estimate >= margin * bar
  LEFT JOIN truth tr ON tr.zone = k.zone AND tr.peak_hour = k.candidate_hour),
scored AS (
  SELECT zone, base_year, variant, margin, sum(CAST(is_peak AS INT))::BIGINT AS captured, count(*) AS alert_hours,
         count(DISTINCT CAST(candidate_hour {MARKET} AS DATE)) AS alert_days,
         round_even(median(CASE WHEN is_peak THEN (epoch(candidate_hour) - epoch(decided_at)) / 3600 END), 1) AS median_lead_hours
  FROM hits GROUP BY 1, 2, 3, 4),
facts AS (
  SELECT t.zone, t.base_year, count(*) AS peaks, sum(CAST({inside_sql('peak_hour')} AS INT))::BIGINT AS peaks_in_window,
         (SELECT count(*) FROM inside i WHERE i.zone = t.zone AND i.base_year = t.base_year) AS in_window_hours
  FROM truth t JOIN win USING (zone) GROUP BY 1, 2),
grid AS (
  SELECT f.zone, f.base_year, v.variant, m.margin, f.peaks, f.peaks_in_window, f.in_window_hours,
         coalesce(captured, 0) AS captured, coalesce(alert_hours, 0) AS alert_hours, coalesce(alert_days, 0) AS alert_days,
         median_lead_hours,
         CASE WHEN in_window_hours > 0 THEN {ratio_sql('peaks_in_window * coalesce(alert_hours, 0)', 'in_window_hours', 100)}
              ELSE 0 END AS chance_captured
  FROM facts f, margins m, (VALUES ('oracle'), ('persist2'), ('persist4'), ('day_ahead')) v(variant)
  LEFT JOIN scored s ON s.zone = f.zone AND s.base_year = f.base_year AND s.variant = v.variant AND s.margin = m.margin),
frontier AS (
  SELECT zone, variant, margin, sum(captured)::BIGINT AS captured, sum(alert_hours)::BIGINT AS alert_hours
  FROM grid WHERE {TRAINED} GROUP BY 1, 2, 3),
chosen AS (
  SELECT zone, variant, margin FROM (SELECT *, {CATCH} * (hi - lo - 1) AS aim FROM frontier, span)
  QUALIFY row_number() OVER (PARTITION BY zone, variant ORDER BY captured >= aim DESC,
    CASE WHEN captured >= aim THEN 0 ELSE -captured END, alert_hours, CASE WHEN captured >= aim THEN -margin ELSE margin END) = 1),
scores AS (
  SELECT g.*, CASE WHEN {TRAINED} THEN 'train' ELSE 'holdout' END AS part
  FROM grid g SEMI JOIN chosen USING (zone, variant, margin))"""
FULL = f"WITH {HOURS}, {DAILY}, {BARS}, {TRUTH}, {WINDOW}, {GRID}"
SCORE_COLUMNS = ["zone", "variant", "margin", "part", "captured", "peaks", "peaks_in_window", "alert_hours", "alert_days",
                 "in_window_hours", "chance_captured", "median_lead_hours"]


def _year():
    return F.col("base_year").cast("bigint").alias("base_year")


def _split(points):
    """(training years, hold-out years): all base years of the series."""
    year = clock.base_year(clock.est_day(F.col("interval_start")))
    lo, hi = points.agg(F.min(year), F.max(year)).first()
    return ([], []) if lo is None else (list(range(lo, hi - 1)), [hi - 1, hi])


def _result(spark, sf):
    points = hourly(spark, sf)
    train, holdout = _split(points)
    return backtest.walk_forward(points, train, holdout, CATCH * len(train))


@register("top5_peaks", f"""WITH {HOURS}, {DAILY}, {TRUTH}
SELECT zone, CAST(base_year AS BIGINT) AS base_year, CAST(rank AS BIGINT) AS rank, CAST(day AS VARCHAR) AS day, peak_hour, peak FROM truth""")
def top5_peaks(spark, sf):
    top = series.top_peaks(series.daily_peaks(demand_hours(spark, sf)))
    return top.select("zone", _year(), F.col("rank").cast("bigint").alias("rank"), F.col("day").cast("string").alias("day"),
                      "peak_hour", "peak")


@register("derive_window", f"""WITH {HOURS}, {DAILY}, {TRUTH}, {WINDOW}
SELECT zone, array_to_string(months, ',') AS months, CAST(he_min AS BIGINT) AS he_min, CAST(he_max AS BIGINT) AS he_max FROM win""")
def derive_window(spark, sf):
    points = hourly(spark, sf)
    window = backtest.derive_window(backtest.truth(series.daily_peaks(points)), _split(points)[0])
    return window.select("zone", F.array_join(F.col("months").cast("array<string>"), ",").alias("months"),
                         F.col("he_min").cast("bigint").alias("he_min"), F.col("he_max").cast("bigint").alias("he_max"))


@register("margin_frontier", f"{FULL} SELECT zone, variant, margin, captured, alert_hours FROM frontier")
def margin_frontier(spark, sf):
    return _result(spark, sf)["frontier"]


@register("chosen_margin", f"{FULL} SELECT zone, variant, margin FROM chosen")
def chosen_margin(spark, sf):
    return _result(spark, sf)["margins"]


@register("backtest_scores", f"""{FULL}
SELECT zone, CAST(base_year AS BIGINT) AS base_year, variant, margin, captured, peaks, peaks_in_window, alert_hours, alert_days,
       in_window_hours, chance_captured, median_lead_hours FROM grid""")
def backtest_scores(spark, sf):
    columns = [c for c in SCORE_COLUMNS if c != "part"]
    return _result(spark, sf)["grid"].select(_year(), *columns)


@register("holdout_totals", f"""{FULL}
SELECT zone, variant, margin, sum(captured)::BIGINT AS captured, sum(peaks)::BIGINT AS peaks, sum(alert_hours)::BIGINT AS alert_hours,
       CAST(sum(CAST(chance_captured AS DECIMAL(18,2))) AS DOUBLE) AS chance_captured
FROM scores WHERE part = 'holdout' GROUP BY 1, 2, 3""")
def holdout_totals(spark, sf):
    return _result(spark, sf)["totals"]


@register("backtest_missed_peaks", f"""{FULL}
SELECT t.zone, CAST(t.base_year AS BIGINT) AS base_year, c.variant, t.peak_hour FROM truth t JOIN chosen c USING (zone)
WHERE NOT EXISTS (
  SELECT 1 FROM hits h WHERE h.zone = t.zone AND h.candidate_hour = t.peak_hour AND h.variant = c.variant AND h.margin = c.margin)""")
def backtest_missed_peaks(spark, sf):
    return _result(spark, sf)["missed"].select("zone", _year(), "variant", "peak_hour")


@register("walk_forward", f"""{FULL}
SELECT zone, CAST(base_year AS BIGINT) AS base_year, variant, margin, part, captured, peaks, peaks_in_window, alert_hours, alert_days,
       in_window_hours, chance_captured, median_lead_hours FROM scores""")
def walk_forward(spark, sf):
    return _result(spark, sf)["scores"].select(_year(), *SCORE_COLUMNS)
