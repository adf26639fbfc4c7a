"""Data quality, the event contract, completeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import clock, contract
from peakledger.operators import merge, quality
from peakledger.plans.catalog.base import EVENTS, READINGS, register
from peakledger.plans.catalog.tables import CURRENT_RANK, RAW_RANK
from peakledger.sources.feeds import damaged_messages, fine_readings, five_minute_values, hourly_values, kept_tables, two_batches, versioned_events

TABLES = f"""{EVENTS},
raw AS (SELECT * FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1),
older AS (SELECT * FROM feed WHERE ingested_at < TIMESTAMP '1998-01-01'),
stale AS (SELECT * FROM older QUALIFY row_number() OVER ({CURRENT_RANK}) = 1)"""


@register("dq_duplicate_keys", f"""WITH {EVENTS}
SELECT count(*) AS violations FROM (SELECT 1 FROM feed GROUP BY report, interval_start, zone HAVING count(*) > 1)""")
def dq_duplicate_keys(spark, sf):
    """The unmerged feed, where most intervals occur more than once."""
    return quality.duplicate_keys(versioned_events(spark, sf))


@register("dq_current_matches_raw", f"""WITH {TABLES}
SELECT count(*) AS violations FROM (SELECT report, interval_start, zone, max(version) AS v FROM raw GROUP BY 1, 2, 3) r
LEFT JOIN stale c USING (report, interval_start, zone) WHERE c.report IS NULL OR c.version <> r.v""")
def dq_current_matches_raw(spark, sf):
    """All versions against a current table that stopped at the end of 1997."""
    feed = versioned_events(spark, sf)
    return quality.current_matches_raw(merge.first_versions(feed), merge.latest_versions(two_batches(feed)[0]))


@register("dq_values_in_range", f"""WITH {READINGS}, h AS (SELECT min(value_mw) AS lo, max(value_mw) AS hi FROM readings WHERE report = 'view')
SELECT count(*) AS violations FROM readings, h WHERE lo IS NULL OR value_mw < 0.8::DOUBLE * lo OR value_mw > 1.2::DOUBLE * hi""")
def dq_values_in_range(spark, sf):
    return quality.values_in_range(fine_readings(spark, sf), history_report="view")


@register("dq_reading_gaps", f"""WITH {READINGS}, d AS (
  SELECT report, CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS day, count(*) AS n FROM readings GROUP BY 1, 2)
SELECT report, CAST(day AS VARCHAR) AS day, n FROM d WHERE n <> 24
  AND EXISTS (SELECT 1 FROM d b WHERE b.report = d.report AND b.day = d.day - 1)
  AND EXISTS (SELECT 1 FROM d a WHERE a.report = d.report AND a.day = d.day + 1)""")
def dq_reading_gaps(spark, sf):
    """Hourly readings: a full day has 24."""
    return quality.incomplete_days(fine_readings(spark, sf), ["report"], 24).select("report", F.col("day").cast("string").alias("day"), "n")


@register("quality_report", f"""WITH {EVENTS},
placed AS (SELECT * REPLACE (CASE WHEN report = 'RealtimeTotals' THEN TIMESTAMP '2000-01-01 05:00:00'
    + to_minutes(CAST(date_diff('minute', TIMESTAMP '2000-01-01 05:00:00', interval_start) // 30 * 5 AS BIGINT)) ELSE interval_start END AS interval_start) FROM feed),
held AS (SELECT * FROM (SELECT * FROM placed WHERE NOT (reason = 'reconciliation' AND version = 7)) QUALIFY row_number() OVER ({CURRENT_RANK}) = 1),
cur AS (SELECT * REPLACE (CASE WHEN report <> 'ICIDemand' AND CAST(floor(value_mw) AS BIGINT) % 97 = 0 THEN value_mw * 100 ELSE value_mw END AS value_mw)
  FROM (SELECT * FROM held UNION ALL SELECT * FROM held WHERE CAST(floor(value_mw) AS BIGINT) % 50 = 0)),
h AS (SELECT min(value_mw) AS lo, max(value_mw) AS hi FROM cur WHERE report = 'ICIDemand'),
d AS (SELECT zone, CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS day, count(*) AS n FROM cur WHERE report = 'RealtimeTotals' GROUP BY 1, 2)
SELECT 'duplicate_keys' AS "check", count(*) AS violations FROM (SELECT 1 FROM cur GROUP BY report, interval_start, zone HAVING count(*) > 1)
UNION ALL SELECT 'current_matches_raw', count(*) FROM (SELECT report, interval_start, zone, max(version) AS v FROM placed GROUP BY 1, 2, 3) r
  LEFT JOIN cur c USING (report, interval_start, zone) WHERE c.report IS NULL OR c.version <> r.v
UNION ALL SELECT 'values_in_range', count(*) FROM cur, h WHERE lo IS NULL OR value_mw < 0.8::DOUBLE * lo OR value_mw > 1.2::DOUBLE * hi
UNION ALL SELECT 'realtime_gaps', count(*) FROM d WHERE n <> 288
  AND EXISTS (SELECT 1 FROM d b WHERE b.zone = d.zone AND b.day = d.day - 1)
  AND EXISTS (SELECT 1 FROM d a WHERE a.zone = d.zone AND a.day = d.day + 1)""")
def quality_report(spark, sf):
    """Whole tables with copies, stale rows, values in the wrong unit, and full days next to days with gaps."""
    return quality.report(*kept_tables(spark, sf))


MESSAGES = """
whole AS (
  SELECT event_id, event_type, event_id % 11 AS damage, '{"schema_version":1,"report":"' || ['RealtimeTotals', 'PredispTotals', 'ICIDemand'][event_id % 3 + 1]
    || '","measure":"ontario_demand","interval_start":"' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ')
    || '","zone":"ONTARIO","version":' || (user_id + 1) || ',"value_mw":' || value || ',"published_at":"'
    || strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') || '","ingested_at":"' || strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ')
    || '","source_uri":"raw/' || event_type || '","content_sha256":"' || sha256(props) || '","reason":"live"}' AS text FROM events),
messages AS (
  SELECT event_id, CASE damage
    WHEN 1 THEN regexp_replace(text, '"value_mw":([^,]*),', '"value_mw":"\\1",')
    WHEN 2 THEN replace(text, ',"reason":"live"', '') WHEN 3 THEN replace(text, '"reason"', '"note":1,"reason"')
    WHEN 4 THEN left(text, length(text) - 1) WHEN 5 THEN replace(text, 'T', ' ')
    WHEN 6 THEN regexp_replace(text, '"version":\\d+', '"version":0') WHEN 7 THEN '[1]'
    WHEN 8 THEN regexp_replace(text, '"version":\\d+', '"version":1.5') WHEN 9 THEN replace(text, '"ONTARIO"', '"' || event_type || '"')
    WHEN 10 THEN regexp_replace(text, '"interval_start":"[0-9]{4}-[0-9]{2}', '"interval_start":"2024-13')
    ELSE text END AS value FROM whole)"""
INSTANT = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$'"


def _instant(name):
    return (f"WHEN NOT regexp_matches(j->>'$.{name}', {INSTANT}) OR (j->>'$.{name}' IS NOT NULL "
            f"AND TRY_CAST(rtrim(j->>'$.{name}', 'Z') AS TIMESTAMP) IS NULL) THEN '{name}'")


@register("contract_check", f"""WITH {MESSAGES}, parsed AS (
  SELECT event_id, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM messages),
judged AS (
  SELECT event_id, list_filter([
    CASE WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'not_an_object' END,
    CASE WHEN json_type(j) = 'OBJECT' AND len(list_intersect(json_keys(j), ['schema_version', 'report', 'measure', 'interval_start', 'zone',
      'version', 'value_mw', 'published_at', 'ingested_at', 'source_uri', 'content_sha256', 'reason'])) < 12 THEN 'missing_field' END,
    CASE WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.note') THEN 'extra_field' END,
    CASE WHEN TRY_CAST(j->>'$.version' AS DOUBLE) < 1 OR TRY_CAST(j->>'$.version' AS DOUBLE) % 1 <> 0 THEN 'version' END,
    CASE WHEN json_type(j, '$.value_mw') = 'VARCHAR' THEN 'value_mw' END,
    CASE WHEN (j->>'$.report') NOT IN ('RealtimeTotals', 'PredispTotals', 'ICIDemand') THEN 'report' END,
    CASE WHEN (j->>'$.zone') <> 'ONTARIO' THEN 'zone' END,
    CASE {_instant('interval_start')} END, CASE {_instant('published_at')} END, CASE {_instant('ingested_at')} END],
    lambda x: x IS NOT NULL) AS broken FROM parsed)
SELECT array_to_string(broken, ',') AS violations, count(*) AS n_messages, min(event_id) AS first_event FROM judged GROUP BY 1""")
def contract_check(spark, sf):
    """One good and ten damaged kinds of message."""
    checked = contract.check(damaged_messages(spark, sf))
    return checked.groupBy(F.array_join("violations", ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.min("event_id").alias("first_event"))


@register("file_completeness", f"""WITH {READINGS}, hours AS (
  SELECT report, CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS day, hour(interval_start - INTERVAL 5 HOUR) + 1 AS he FROM readings)
SELECT report, CAST(day AS VARCHAR) AS day, count(*) AS hours, CAST(list_sort(list(he)) = range(1, 25) AS BIGINT) AS complete,
       CAST(list_sort(list(he)) = range(1, count(*) + 1) AS BIGINT) AS prefix FROM hours GROUP BY 1, 2""")
def file_completeness(spark, sf):
    """A day is complete with hours 1..24, and a prefix with hours 1..N: told from counts, without collecting the hours."""
    from peakledger.operators.completeness import positions
    readings = fine_readings(spark, sf).withColumn("day", clock.est_day(F.col("interval_start"))).withColumn(
        "he", clock.hour_ending(F.col("interval_start")))
    return positions(readings, ["report", "day"], "he", 24).select(
        "report", F.col("day").cast("string").alias("day"), F.col("n").alias("hours"),
        F.col("complete").cast("bigint").alias("complete"), F.col("prefix").cast("bigint").alias("prefix"))


@register("hourly_vs_interval_check", """WITH five AS (
  SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS slot, sum(CAST(value AS DECIMAL(18,2))) AS mw FROM events GROUP BY 1, 2),
fine AS (SELECT event_type, date_trunc('hour', slot) AS hour, count(*) AS slots, round_even(CAST(sum(mw) AS DOUBLE) / count(*), 0) AS mean_mw FROM five GROUP BY 1, 2),
published AS (SELECT event_type, date_trunc('hour', ts) AS hour, round_even(CAST(coalesce(sum(CAST(value AS DECIMAL(18,2)))
  FILTER (WHERE hour(ts) % 6 <> 0 OR user_id % 5 <> 0), 0) AS DOUBLE) / count(DISTINCT minute(ts) // 5), 0) AS value_mw FROM events GROUP BY 1, 2)
SELECT event_type AS report, count(*) AS hours, count(*) FILTER (WHERE abs(mean_mw - value_mw) > 0.5) AS apart,
       max(slots) AS most_slots, max(mean_mw) AS highest_mean
FROM fine JOIN published USING (event_type, hour) GROUP BY 1""")
def hourly_vs_interval_check(spark, sf):
    """Hourly reports, some of which miss readings, against the mean of the five-minute values."""
    from peakledger.operators.completeness import hourly_against_fine
    return hourly_against_fine(hourly_values(spark, sf), five_minute_values(spark, sf))
