"""Freshness, latency, lag, alerts, load tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import clock
from peakledger.operators import changes, metrics, sketches
from peakledger.plans.catalog.base import EVENTS, SAMPLES, ratio_sql, register
from peakledger.plans.catalog.tables import COARSE, in_steps
from peakledger.sources.feeds import load_samples, metric_samples, offsets, table, versioned_events


@register("ingest_counters", f"""WITH {COARSE}, ordered AS (
  SELECT *, lag(value_mw) OVER (PARTITION BY report, interval_start, zone
                                ORDER BY version, ingested_at, published_at, source_uri, value_mw) AS p FROM steps)
SELECT report, CASE WHEN value_mw IS DISTINCT FROM p THEN 'events_produced' ELSE 'events_deduplicated' END AS outcome, count(*) AS "count"
FROM ordered GROUP BY 1, 2""")
def ingest_counters(spark, sf):
    """Events produced and dropped as unchanged, per report."""
    return metrics.outcome_counts(changes.judged_values(in_steps(versioned_events(spark, sf))))


@register("latency_percentiles", f"""WITH {EVENTS}, l AS (
  SELECT report, CAST(epoch(ingested_at) - epoch(published_at) AS BIGINT) AS s,
         row_number() OVER (PARTITION BY report ORDER BY epoch(ingested_at) - epoch(published_at)) - 1 AS i,
         count(*) OVER (PARTITION BY report) AS n FROM feed WHERE reason = 'live')
SELECT report, n, max(CASE WHEN i = n // 2 THEN s END) AS latency_p50_s, max(CASE WHEN i = floor(n * 0.95::DOUBLE) THEN s END) AS latency_p95_s,
       max(s) AS latency_max_s FROM l GROUP BY 1, 2""")
def latency_percentiles(spark, sf):
    return metrics.latency_percentiles(versioned_events(spark, sf))


@register("data_age", f"""WITH {EVENTS}
SELECT report, max(published_at) AS newest_published, epoch(TIMESTAMP '2002-01-01') - epoch(max(published_at)) AS data_age_s FROM feed GROUP BY 1""")
def data_age(spark, sf):
    return metrics.data_age(versioned_events(spark, sf), F.lit("2002-01-01").cast("timestamp_ntz"))


@register("partition_lag", """WITH o AS (
  SELECT event_type AS topic, CAST(user_id % 6 AS VARCHAR) AS partition, count(*) AS high, 0 AS low,
         CASE WHEN user_id % 6 % 3 = 0 THEN count(*) FILTER (WHERE value < 60) ELSE -1001 END AS position,
         CASE WHEN user_id % 6 % 3 < 2 THEN count(*) FILTER (WHERE value < 40) ELSE -1001 END AS committed
  FROM events GROUP BY event_type, user_id % 6),
l AS (SELECT topic, partition, greatest(0, high - CASE WHEN position >= 0 THEN position WHEN committed >= 0 THEN committed ELSE low END) AS lag FROM o)
SELECT coalesce(topic, 'all') AS topic, coalesce(partition, 'all') AS partition, sum(lag)::BIGINT AS lag FROM l GROUP BY ROLLUP (topic, partition)""")
def partition_lag(spark, sf):
    return metrics.partition_lag(offsets(spark, sf))


@register("drain_summary", f"""WITH samples AS (
  SELECT event_type || '/' || strftime(ts, '%Y-%m-%d') AS run, CAST(epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts)) AS BIGINT) AS t,
         user_id % 7 AS replicas, greatest(0, CAST(floor(value) AS BIGINT) - 30) AS lag FROM events),
facts AS (SELECT run, max(lag) AS peak, min(CASE WHEN lag = 0 AND t > 0 THEN t END) AS drained, max(replicas) AS most,
          min(CASE WHEN replicas >= 2 THEN t END) AS up FROM samples GROUP BY 1),
tops AS (SELECT s.run, min(t) AS peak_at FROM samples s JOIN facts f ON f.run = s.run AND s.replicas = f.most GROUP BY 1)
SELECT run, peak AS peak_lag_events, drained::DOUBLE AS drain_seconds,
       CASE WHEN drained IS NOT NULL THEN {ratio_sql('peak', 'drained', 10)} END AS events_per_second, most AS max_replicas,
       up::DOUBLE AS first_scaled_up_at_seconds,
       CASE WHEN up IS NOT NULL AND drained IS NOT NULL THEN
         (SELECT min(t) FROM samples s WHERE s.run = f.run AND s.replicas <= 1 AND s.t > p.peak_at AND s.t >= f.drained) END::DOUBLE
         AS back_to_one_replica_at_seconds
FROM facts f JOIN tops p USING (run)""")
def drain_summary(spark, sf):
    out = metrics.drain_summary(load_samples(spark, sf))
    nullable = ["drain_seconds", "first_scaled_up_at_seconds", "back_to_one_replica_at_seconds"]
    return out.select(*[F.col(c).cast("double").alias(c) if c in nullable else F.col(c) for c in out.columns])


def _ticks(inner, width, fold):
    return f"""SELECT service, minute + to_minutes(k) AS tick, {fold} AS observed FROM ({inner}), range(0, {width}) r(k) GROUP BY 1, 2"""


@register("alert_windows", f"""WITH {SAMPLES},
age AS (SELECT service, date_trunc('minute', ts) AS minute, max(value) AS v FROM samples GROUP BY 1, 2),
latest AS (SELECT service, partition, date_trunc('minute', ts) AS minute, CAST(arg_max(value, (ts, value)) AS DECIMAL(18,2)) AS v FROM samples GROUP BY 1, 2, 3),
lag AS (SELECT service, minute, sum(v) AS v FROM latest GROUP BY 1, 2),
bad AS (SELECT service, date_trunc('minute', ts) AS minute, count(*) AS v FROM samples WHERE value > 50 GROUP BY 1, 2)
SELECT 'stale' AS alert, service, tick, observed FROM ({_ticks('SELECT * FROM age', 10, 'max(v)')}) WHERE observed > 150
UNION ALL SELECT 'lag', service, tick, observed FROM ({_ticks('SELECT * FROM lag', 5, 'CAST(min(v) AS DOUBLE)')}) WHERE observed > 100
UNION ALL SELECT 'failures', service, tick, observed FROM ({_ticks('SELECT * FROM bad', 15, 'CAST(sum(v) AS DOUBLE)')}) WHERE observed > 1""")
def alert_windows(spark, sf):
    """The three rules with thresholds that suit the samples."""
    rows = metric_samples(spark, sf)
    parts = {"stale": metrics.stale_alerts(rows, 150), "lag": metrics.lag_alerts(rows, 100),
             "failures": metrics.failure_alerts(rows.where(F.col("value") > 50), 1)}
    shown = [df.select(F.lit(name).alias("alert"), "service", "tick", "observed") for name, df in parts.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@register("no_data_gaps", f"""WITH {SAMPLES}
SELECT service, ts AS silent_from, following AS silent_until, CAST(CAST((epoch_us(following) - epoch_us(ts)) AS DECIMAL(20,0)) / 1000000 AS DOUBLE) AS seconds,
       back IS NULL AS still_silent
FROM (SELECT *, coalesce(back, TIMESTAMP '2024-02-01') AS following FROM (SELECT service, ts, lead(ts) OVER (PARTITION BY service ORDER BY ts) AS back FROM samples))
WHERE following > ts + INTERVAL 20 MINUTE""")
def no_data_gaps(spark, sf):
    """As seen a day after the last samples, when every service is silent."""
    return metrics.silences(metric_samples(spark, sf), as_of=F.lit("2024-02-01").cast("timestamp_ntz"))


@register("health_rollup", f"""WITH {SAMPLES}, ranked AS (
  SELECT service, date_trunc('hour', ts) AS period, value, count(*) OVER (PARTITION BY service, date_trunc('hour', ts)) AS n,
         row_number() OVER (PARTITION BY service, date_trunc('hour', ts) ORDER BY value) - 1 AS i FROM samples)
SELECT service, period, count(*) AS samples, max(value) AS highest, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) AS total,
       max(CASE WHEN i = floor(n * 0.95::DOUBLE) THEN value END) AS p95, count(*) / 3600.0::DOUBLE AS per_second
FROM ranked GROUP BY 1, 2""")
def health_rollup(spark, sf):
    return metrics.health_rollup(metric_samples(spark, sf))


@register("health_by_day", f"""WITH {SAMPLES}
SELECT service, date_trunc('day', ts)::TIMESTAMP AS period, count(*) AS samples, max(value) AS highest,
       CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) AS total, count(*) / 86400.0::DOUBLE AS per_second, true AS p95_close
FROM samples GROUP BY 1, 2""")
def health_by_day(spark, sf):
    """Minutes rolled up to hours and days; ``p95_close`` says that the sketch's percentile is within 1 % of the samples of the exact one."""
    samples = metric_samples(spark, sf)
    out = sketches.figures(sketches.days(sketches.hours(sketches.per_minute(samples))), 86_400)
    bounds = sketches.rank_bounds(samples, out, F.col("ts").cast("date").cast("timestamp_ntz"))
    close = (F.col("below") <= metrics.P95 + 0.01) & (F.col("up_to") >= metrics.P95 - 0.01)
    return out.join(bounds.select("service", "period", close.alias("p95_close")), ["service", "period"]).select(
        "service", "period", "samples", "highest", "total", "per_second", "p95_close")


@register("publication_lag", """
SELECT event_type AS report, count(*) AS n, median(CAST(floor(value) AS BIGINT)) AS median_minutes,
       count(*) FILTER (WHERE floor(value) <= 20) / count(*)::DOUBLE AS share_within FROM events GROUP BY 1""")
def publication_lag(spark, sf):
    files = table(spark, sf, "events").select(F.col("event_type").alias("report"), F.floor("value").alias("minutes"))
    return metrics.publication_lag(files)


@register("recent_live_gate", f"""WITH {EVENTS}
SELECT report, count(*) AS n_events, max(ingested_at) AS newest, min(ingested_at) AS oldest FROM feed
WHERE reason = 'live' AND ingested_at >= TIMESTAMP '2001-06-01' - INTERVAL 3 HOUR - INTERVAL 90 DAY GROUP BY 1""")
def recent_live_gate(spark, sf):
    """Live events no older than the limit; here ninety days and three hours before June 2001."""
    from peakledger.operators.live import recent_live
    now = F.lit("2001-06-01").cast("timestamp_ntz")
    rows = recent_live(versioned_events(spark, sf), now, hours=90 * 24 + 3)
    return rows.groupBy("report").agg(F.count(F.lit(1)).alias("n_events"), F.max("ingested_at").alias("newest"),
                                      F.min("ingested_at").alias("oldest"))
