"""Series and the peak-risk rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import clock
from peakledger.operators import asof, merge, rule, series
from peakledger.operators.durable import checkpoint
from peakledger.plans.catalog.base import BARS, DAILY, HOURS, register
from peakledger.sources.feeds import demand_hours, hour_versions

# The feed's summer and hours; margins low enough that every branch of the rule is met.
MONTHS, HE_MIN, HE_MAX = [6, 7, 8, 9], 12, 18
MARGINS = {"oracle": 1.0, "persist2": 0.9, "persist4": 0.85, "day_ahead": 0.95}

VARIANTS_SQL = "(VALUES ('oracle', 1.0::DOUBLE), ('persist2', 0.9), ('persist4', 0.85), ('day_ahead', 0.95)) v(variant, margin)"
MARKET = "- INTERVAL 5 HOUR"
DECISION = """CASE variant WHEN 'oracle' THEN candidate_hour
         WHEN 'persist2' THEN candidate_hour - INTERVAL 45 MINUTE WHEN 'persist4' THEN candidate_hour - INTERVAL 165 MINUTE
         ELSE date_trunc('day', candidate_hour - INTERVAL 5 HOUR) + INTERVAL 315 MINUTE END"""
INSIDE = f"(month(candidate_hour {MARKET}) IN (6, 7, 8, 9) AND hour(candidate_hour {MARKET}) + 1 BETWEEN 12 AND 18)"


def decide_sql(candidates: str) -> str:
    """CTEs up to ``decided``; ``candidates`` is a relation with zone, variant, candidate_hour, margin, in_window."""
    return f"""
timed AS (
  SELECT *, {DECISION} AS decided_at,
         year(CAST(candidate_hour {MARKET} AS DATE) - INTERVAL 4 MONTH) AS base_year
  FROM ({candidates})),
looked AS (
  SELECT t.*, CASE WHEN NOT t.in_window THEN NULL WHEN variant = 'day_ahead' THEN d.peak ELSE p.mw END AS estimate
  FROM timed t
  LEFT JOIN points p ON p.zone = t.zone AND p.interval_start = t.candidate_hour
       - CASE variant WHEN 'persist2' THEN INTERVAL 2 HOUR WHEN 'persist4' THEN INTERVAL 4 HOUR ELSE INTERVAL 0 HOUR END
  LEFT JOIN daily d ON d.zone = t.zone AND d.day = CAST(t.candidate_hour {MARKET} AS DATE) - 1),
barred AS (
  SELECT l.*, CASE WHEN estimate IS NOT NULL THEN b.bar END AS bar
  FROM looked l LEFT JOIN bars b ON b.zone = l.zone AND b.base_year = l.base_year
       AND b.eff_day = CAST(l.decided_at - INTERVAL 15 MINUTE {MARKET} AS DATE)),
decided AS (SELECT *, coalesce(estimate >= margin * bar, false) AS risk FROM barred)"""


EVERY_HOUR = f"SELECT zone, interval_start AS candidate_hour, variant, margin, {INSIDE} AS in_window FROM points, {VARIANTS_SQL}" \
    .replace("candidate_hour -", "interval_start -")
RULE = f"WITH {HOURS}, {DAILY}, {BARS}, {decide_sql(EVERY_HOUR)}"
REASON_KIND = """CASE WHEN NOT in_window THEN 'outside' WHEN estimate IS NULL THEN 'no_data' WHEN bar IS NULL THEN 'warm_up'
  WHEN risk THEN 'reaches' ELSE 'below' END"""


def _windowed(df):
    return rule.with_params(df, MARGINS, MONTHS, HE_MIN, HE_MAX)


def hourly(spark, sf):
    """The hourly series, worked out once from the raw rows: the rule reads it several times over."""
    return checkpoint(demand_hours(spark, sf))


def decisions(spark, sf):
    points = hourly(spark, sf)
    return rule.decide(_windowed(rule.every_hour(points)), points)


def _text(day):
    return day.cast("string")


@register("peak_risk_flags", f"""{RULE}
SELECT zone, variant, candidate_hour, decided_at, estimate, bar, margin FROM decided WHERE risk""")
def peak_risk_flags(spark, sf):
    return decisions(spark, sf).where(F.col("in_window") & F.col("risk")).select(
        "zone", "variant", "candidate_hour", "decided_at", "estimate", "bar", "margin")


VERSIONS = """
vers AS (
  SELECT zone, interval_start, CAST(sum(q) OVER (PARTITION BY zone, interval_start ORDER BY stage) AS DOUBLE) AS mw,
         CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS day,
         interval_start + CASE stage WHEN 0 THEN INTERVAL 70 MINUTE WHEN 1 THEN INTERVAL 6 HOUR ELSE INTERVAL 73 HOUR END AS known_at
  FROM (SELECT l_returnflag AS zone, date_trunc('day', l_shipdate) + to_hours(CAST(l_partkey % 9 + 15 AS BIGINT)) AS interval_start,
               greatest(0, l_linenumber - 5) AS stage, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1, 2, 3)),
day_peaks AS (
  SELECT zone, day, since, max(mw) AS peak FROM (
    SELECT p.zone, p.day, p.since, v.interval_start, arg_max(v.mw, v.known_at) AS mw
    FROM (SELECT DISTINCT zone, day, known_at AS since FROM vers) p JOIN vers v ON v.zone = p.zone AND v.day = p.day AND v.known_at <= p.since
    GROUP BY ALL) GROUP BY ALL)"""


@register("flags_as_known", f"""WITH {HOURS}, {VERSIONS},
asked AS (
  SELECT *, {DECISION} AS decided_at, year(CAST(candidate_hour {MARKET} AS DATE) - INTERVAL 4 MONTH) AS base_year FROM (
    SELECT zone, interval_start AS candidate_hour, variant, margin FROM points, {VARIANTS_SQL}) WHERE variant <> 'oracle' AND {INSIDE}),
guesses AS (
  SELECT a.zone, a.variant, a.candidate_hour, arg_max(v.mw, v.known_at) AS estimate
  FROM asked a JOIN vers v ON v.zone = a.zone AND v.known_at <= a.decided_at
       AND v.interval_start = a.candidate_hour - CASE variant WHEN 'persist2' THEN INTERVAL 2 HOUR ELSE INTERVAL 4 HOUR END
  WHERE variant <> 'day_ahead' GROUP BY ALL
  UNION ALL
  SELECT a.zone, a.variant, a.candidate_hour, arg_max(d.peak, d.since)
  FROM asked a JOIN day_peaks d ON d.zone = a.zone AND d.day = CAST(a.candidate_hour {MARKET} AS DATE) - 1 AND d.since <= a.decided_at
  WHERE variant = 'day_ahead' GROUP BY ALL),
known_bars AS (
  SELECT zone, base_year, decided_at, list_reverse_sort(list(peak))[5] AS bar FROM (
    SELECT q.zone, q.base_year, q.decided_at, d.day, arg_max(d.peak, d.since) AS peak
    FROM (SELECT DISTINCT zone, base_year, decided_at, CAST(decided_at - INTERVAL 15 MINUTE {MARKET} AS DATE) AS eff_day FROM asked) q
    JOIN day_peaks d ON d.zone = q.zone AND year(d.day - INTERVAL 4 MONTH) = q.base_year AND d.day < q.eff_day AND d.since <= q.decided_at
    GROUP BY ALL) GROUP BY ALL)
SELECT a.zone, a.variant, a.candidate_hour, a.decided_at, estimate, bar, margin
FROM asked a JOIN guesses USING (zone, variant, candidate_hour) JOIN known_bars b ON b.zone = a.zone AND b.base_year = a.base_year AND b.decided_at = a.decided_at
WHERE estimate >= margin * bar""")
def flags_as_known(spark, sf):
    """As peak_risk_flags, with every value as it was known when the decision was taken, before it was restated."""
    asked = _windowed(rule.every_hour(demand_hours(spark, sf), clock.LIVE_VARIANTS))
    return asof.decide_as_known(asked, checkpoint(hour_versions(spark, sf))).where("risk").select(
        "zone", "variant", "candidate_hour", "decided_at", "estimate", "bar", "margin")


@register("flag_reasons", f"""{RULE}
SELECT zone, variant, {REASON_KIND} AS kind, count(*) AS decisions,
       min(CASE WHEN NOT in_window THEN 'outside the plausible peak window'
                WHEN estimate IS NULL THEN 'no demand data to estimate from'
                WHEN bar IS NULL THEN 'warm-up: fewer than 5 complete days in this base period'
                WHEN risk THEN 'estimate ' || format('{{:,}}', CAST(estimate AS BIGINT)) || ' MW reaches '
                  || printf('%.2f', margin) || ' x ' || format('{{:,}}', CAST(bar AS BIGINT))
                  || ' MW (5th-highest daily peak so far)'
                ELSE 'estimate ' || format('{{:,}}', CAST(estimate AS BIGINT)) || ' MW is below '
                  || printf('%.2f', margin) || ' x ' || format('{{:,}}', CAST(bar AS BIGINT)) || ' MW' END) AS first_reason
FROM decided GROUP BY 1, 2, 3""")
def flag_reasons(spark, sf):
    return (decisions(spark, sf).groupBy("zone", "variant", rule.reason_kind().alias("kind"))
            .agg(F.count(F.lit(1)).alias("decisions"), F.min(rule.reason_text()).alias("first_reason")))


@register("daily_peaks", f"""WITH {HOURS}, {DAILY} SELECT zone, CAST(day AS VARCHAR) AS day, peak, hours FROM daily""")
def daily_peaks(spark, sf):
    return series.daily_peaks(demand_hours(spark, sf)).select("zone", _text(F.col("day")).alias("day"), "peak", "hours")


@register("daily_peak_hour", f"""WITH {HOURS}, {DAILY}
SELECT zone, CAST(day AS VARCHAR) AS day, peak, peak_hour, CAST(hour(peak_hour {MARKET}) + 1 AS BIGINT) AS hour_ending FROM daily""")
def daily_peak_hour(spark, sf):
    return series.daily_peaks(demand_hours(spark, sf)).select(
        "zone", _text(F.col("day")).alias("day"), "peak", "peak_hour",
        clock.hour_ending(F.col("peak_hour")).cast("bigint").alias("hour_ending"))


@register("running_fifth_peak", f"""WITH {HOURS}, {DAILY}, {BARS}
SELECT b.zone, CAST(base_year AS BIGINT) AS base_year, CAST(eff_day AS VARCHAR) AS day, peak, bar
FROM bars b JOIN daily d ON d.zone = b.zone AND d.day = b.eff_day""")
def running_fifth_peak(spark, sf):
    daily = series.daily_peaks(demand_hours(spark, sf))
    days = daily.select("zone", clock.base_year(F.col("day")).alias("base_year"), "day", "peak")
    bars = series.bars(daily).withColumnRenamed("eff_day", "day")
    return days.join(bars, ["zone", "base_year", "day"], "left").select(
        "zone", F.col("base_year").cast("bigint").alias("base_year"), _text(F.col("day")).alias("day"), "peak", "bar")


@register("bar_asof", f"""{RULE}
SELECT zone, variant, candidate_hour, decided_at, bar FROM decided WHERE in_window AND estimate IS NOT NULL""")
def bar_asof(spark, sf):
    return (decisions(spark, sf).where(F.col("in_window") & F.col("estimate").isNotNull())
            .select("zone", "variant", "candidate_hour", "decided_at", "bar"))


@register("persist_estimates", f"""WITH {HOURS}
SELECT p.zone, p.interval_start AS candidate_hour, a.mw AS two_hours_ago, b.mw AS four_hours_ago
FROM points p LEFT JOIN points a ON a.zone = p.zone AND a.interval_start = p.interval_start - INTERVAL 2 HOUR
LEFT JOIN points b ON b.zone = p.zone AND b.interval_start = p.interval_start - INTERVAL 4 HOUR""")
def persist_estimates(spark, sf):
    points = demand_hours(spark, sf)
    hours = rule.every_hour(points, tuple(clock.STALENESS))
    return (rule.estimates(hours, points, series.daily_peaks(points)).groupBy("zone", "candidate_hour")
            .agg(F.max(F.when(F.col("variant") == "persist2", F.col("estimate"))).alias("two_hours_ago"),
                 F.max(F.when(F.col("variant") == "persist4", F.col("estimate"))).alias("four_hours_ago")))


@register("day_ahead_estimates", f"""WITH {HOURS}, {DAILY}
SELECT t.zone, CAST(t.day AS VARCHAR) AS day, y.peak AS yesterday FROM daily t
LEFT JOIN daily y ON y.zone = t.zone AND y.day = t.day - 1""")
def day_ahead_estimates(spark, sf):
    daily = series.daily_peaks(demand_hours(spark, sf))
    yesterday = daily.select("zone", F.date_add("day", 1).alias("day"), F.col("peak").alias("yesterday"))
    return daily.select("zone", "day").join(yesterday, ["zone", "day"], "left").select(
        "zone", _text(F.col("day")).alias("day"), "yesterday")


@register("decision_times", f"""WITH {HOURS}, timed AS (
  SELECT zone, candidate_hour, variant, {DECISION} AS decided_at
  FROM (SELECT zone, interval_start AS candidate_hour, variant FROM points, {VARIANTS_SQL}))
SELECT zone, variant, candidate_hour, decided_at, (epoch(candidate_hour) - epoch(decided_at)) / 3600 AS notice_hours FROM timed""")
def decision_times(spark, sf):
    timed = rule.every_hour(demand_hours(spark, sf)).withColumn(
        "decided_at", clock.decision_time(F.col("variant"), F.col("candidate_hour")))
    return timed.select("zone", "variant", "candidate_hour", "decided_at",
                        clock.notice_hours(F.col("candidate_hour"), F.col("decided_at")).alias("notice_hours"))


# The feed has no readings at hour-ending 24, so each day's last hour stands in for the day being over.
CANDIDATES_SQL = f"""
newest AS (SELECT zone, interval_start FROM points
  UNION ALL SELECT zone, day + INTERVAL 28 HOUR FROM daily),
candidates AS (
  SELECT zone, interval_start AS latest_start, 'persist2' AS variant, interval_start + INTERVAL 2 HOUR AS candidate_hour FROM newest
  UNION ALL SELECT zone, interval_start, 'persist4', interval_start + INTERVAL 4 HOUR FROM newest
  UNION ALL SELECT zone, interval_start, 'day_ahead', interval_start + to_hours(he) FROM newest, range(12, 19) h(he)
    WHERE hour(interval_start {MARKET}) = 23 AND month(interval_start + INTERVAL 19 HOUR) IN (6, 7, 8, 9))"""


def newest_hours(points):
    """Every hour as it becomes public, plus the closing hour of each day."""
    closing = series.daily_peaks(points).select("zone", (clock.est_midnight(F.col("day")) + clock.hours(23)).alias("interval_start"))
    both = points.select("zone", "interval_start").unionByName(closing)
    return (both.withColumn("months", F.array(*[F.lit(m) for m in MONTHS]))
            .withColumn("he_min", F.lit(HE_MIN)).withColumn("he_max", F.lit(HE_MAX)))


@register("live_candidates", f"""WITH {HOURS}, {DAILY}, {CANDIDATES_SQL}
SELECT zone, latest_start, variant, candidate_hour FROM candidates""")
def live_candidates(spark, sf):
    return rule.live_candidates(newest_hours(hourly(spark, sf))).select("zone", "latest_start", "variant", "candidate_hour")


LIVE = f"""WITH {HOURS}, {DAILY}, {BARS}, {CANDIDATES_SQL}, {decide_sql(
    f"SELECT zone, variant, candidate_hour, latest_start, margin, {INSIDE} AS in_window FROM candidates JOIN {VARIANTS_SQL} USING (variant)")}"""


def live_decision_rows(points):
    candidates = rule.live_candidates(newest_hours(points))
    margins = [x for v, m in MARGINS.items() for x in (F.lit(v), F.lit(m))]
    return rule.decide(candidates.withColumn("margin", F.create_map(*margins)[F.col("variant")]), points)


@register("live_decisions", f"""{LIVE}
SELECT zone, latest_start, variant, candidate_hour, decided_at, CAST(risk AS BIGINT) AS risk, {REASON_KIND} AS kind,
       estimate AS estimate_mw, bar AS bar_mw, (epoch(candidate_hour) - epoch(decided_at)) / 3600 AS notice_hours FROM decided""")
def live_decisions(spark, sf):
    rows = live_decision_rows(hourly(spark, sf))
    return rows.select("zone", "latest_start", "variant", "candidate_hour", "decided_at", F.col("risk").cast("bigint").alias("risk"),
                       rule.reason_kind().alias("kind"), F.col("estimate").alias("estimate_mw"), F.col("bar").alias("bar_mw"),
                       clock.notice_hours(F.col("candidate_hour"), F.col("decided_at")).alias("notice_hours"))


@register("replay_day", f"""{LIVE}, hottest AS (
  SELECT zone, arg_max(day, (peak, -epoch(day))) AS day FROM daily WHERE month(day) IN (6, 7, 8, 9) GROUP BY 1)
SELECT d.zone, CAST(h.day AS VARCHAR) AS replayed, d.latest_start, d.variant, d.candidate_hour, d.decided_at,
       d.estimate AS estimate_mw, d.bar AS bar_mw
FROM decided d JOIN hottest h ON h.zone = d.zone
WHERE risk AND d.latest_start >= h.day - INTERVAL 19 HOUR AND d.latest_start < h.day + INTERVAL 29 HOUR""")
def replay_day(spark, sf):
    from peakledger.plans.replay import replay
    points = hourly(spark, sf)
    summer = series.daily_peaks(points).where(F.month("day").isin(MONTHS))
    hottest = summer.groupBy("zone").agg(F.max_by("day", F.struct("peak", -F.unix_date("day"))).alias("day"))
    margins = [x for v, m in MARGINS.items() for x in (F.lit(v), F.lit(m))]
    newest = newest_hours(points).withColumn("margins", F.create_map(*margins))
    return replay(points, newest, hottest).select(
        "zone", _text(F.col("day")).alias("replayed"), "latest_start", "variant", "candidate_hour", "decided_at",
        F.col("estimate").alias("estimate_mw"), F.col("bar").alias("bar_mw"))


@register("hour_ending_roundtrip", """
SELECT CAST(l_partkey % 26 AS BIGINT) AS he, count(*) AS n_rows,
       min(CASE WHEN l_partkey % 26 BETWEEN 1 AND 24 THEN l_shipdate + to_hours(CAST(l_partkey % 26 + 4 AS BIGINT)) END) AS first_start,
       sum(CASE WHEN l_partkey % 26 BETWEEN 1 AND 24 THEN 1 ELSE 0 END)::BIGINT AS round_trips
FROM lineitem GROUP BY 1""")
def hour_ending_roundtrip(spark, sf):
    from peakledger.sources.feeds import table
    he = F.col("l_partkey") % 26
    start = clock.hour_ending_to_utc(F.col("l_shipdate").cast("date"), he)
    back = (clock.hour_ending(F.col("start")) == F.col("he")) & (clock.est_day(F.col("start")) == F.col("l_shipdate").cast("date"))
    return (table(spark, sf, "lineitem").select("l_shipdate", he.alias("he"), start.alias("start"))
            .groupBy("he").agg(F.count(F.lit(1)).alias("n_rows"), F.min("start").alias("first_start"),
                               F.count_if(back).alias("round_trips")))


@register("base_period_rollup", f"""WITH {HOURS}, {DAILY}
SELECT zone, CAST(year(day - INTERVAL 4 MONTH) AS BIGINT) AS base_year, count(*) AS n_days, CAST(min(day) AS VARCHAR) AS first_day,
       CAST(max(day) AS VARCHAR) AS last_day, max(peak) AS highest FROM daily GROUP BY 1, 2""")
def base_period_rollup(spark, sf):
    daily = series.daily_peaks(demand_hours(spark, sf))
    return daily.groupBy("zone", clock.base_year(F.col("day")).cast("bigint").alias("base_year")).agg(
        F.count(F.lit(1)).alias("n_days"), _text(F.min("day")).alias("first_day"), _text(F.max("day")).alias("last_day"),
        F.max("peak").alias("highest"))


@register("series_gaps", f"""WITH {HOURS}
SELECT zone, interval_start AS gap_after, following AS gap_until,
       CAST((epoch(following) - epoch(interval_start)) / 3600 - 1 AS BIGINT) AS missing
FROM (SELECT zone, interval_start, lead(interval_start) OVER (PARTITION BY zone ORDER BY interval_start) AS following FROM points)
WHERE following > interval_start + INTERVAL 1 HOUR""")
def series_gaps(spark, sf):
    return series.gaps(demand_hours(spark, sf))


SIGNALS_SQL = f"""{LIVE}, signals AS (
  SELECT zone, variant, candidate_hour, decided_at, risk, estimate AS estimate_mw, bar AS bar_mw, {REASON_KIND} AS kind,
         latest_start + INTERVAL 75 MINUTE AS evaluated_at FROM decided)"""


def signals_feed(points):
    evaluated = F.col("latest_start") + clock.minutes(75)
    return live_decision_rows(points).withColumn("evaluated_at", evaluated)


@register("signals_insert_once", f"""{SIGNALS_SQL}
SELECT zone, variant, count(*) AS n_rows, sum(CAST(risk AS INT))::BIGINT AS at_risk, min(evaluated_at) AS first_evaluated
FROM (SELECT * FROM signals QUALIFY row_number() OVER (PARTITION BY zone, variant, candidate_hour, decided_at ORDER BY evaluated_at) = 1)
GROUP BY 1, 2""")
def signals_insert_once(spark, sf):
    """The first half of the rows is stored, then everything is sent again."""
    points = hourly(spark, sf)
    rows = rule.signal_rows(signals_feed(points), F.col("latest_start") + clock.minutes(75))
    early = F.col("evaluated_at") < F.lit("1998-01-01").cast("timestamp_ntz")
    nothing = rows.where(F.lit(False))
    stored = merge.new_signals(nothing, rows.where(early))
    table = stored.unionByName(merge.new_signals(stored, rows))
    return table.groupBy("zone", "variant").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("risk").alias("at_risk"), F.min("evaluated_at").alias("first_evaluated"))


@register("latest_signals", f"""{SIGNALS_SQL}
SELECT zone, evaluated_at, variant, candidate_hour, CAST(risk AS BIGINT) AS risk, estimate_mw, bar_mw, kind FROM signals
ORDER BY evaluated_at DESC, candidate_hour, zone, variant LIMIT 12""")
def latest_signals(spark, sf):
    rows = signals_feed(hourly(spark, sf)).select(
        "zone", "evaluated_at", "variant", "candidate_hour", F.col("risk").cast("bigint").alias("risk"),
        F.col("estimate").alias("estimate_mw"), F.col("bar").alias("bar_mw"), rule.reason_kind().alias("kind"))
    return rows.orderBy(F.desc("evaluated_at"), "candidate_hour", "zone", "variant").limit(12)
