"""The report parsers and the listing scan, over texts written out of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.plans.catalog.base import FILES, register
from peakledger.sources import listing, report_texts, reports


def _rows(files):
    """One row per parsed reading; one row with the error for a bad file."""
    parsed = reports.parse(files)
    return parsed.select("name", "error", F.explode_outer("rows").alias("r")).select(
        "name", "error", "r.interval_start", F.col("r.hour_ending").cast("bigint").alias("hour_ending"), "r.value_mw",
        F.col("r.total_load_mw").alias("load_mw"))


NOTHING = "NULL::TIMESTAMP AS interval_start, NULL::BIGINT AS hour_ending, NULL::DOUBLE AS value_mw, NULL::DOUBLE AS load_mw"


@register("parse_hourly_files", f"""WITH hours AS (
  SELECT event_type, CAST(ts AS DATE) AS day, hour(ts) AS h, sum(CAST(value AS DECIMAL(18,2))) AS mw FROM events GROUP BY 1, 2, 3),
named AS (SELECT *, 'PUB_ICIDemand_' || event_type || '_' || strftime(day, '%Y%m%d') || '_v1.csv' AS name, day(day) % 5 AS damage FROM hours)
SELECT name, NULL::VARCHAR AS error, day + INTERVAL 5 HOUR + to_hours(h) AS interval_start, h + 1 AS hour_ending, CAST(mw AS DOUBLE) AS value_mw, NULL::DOUBLE AS load_mw
FROM named WHERE damage > 1
UNION ALL SELECT name, 'first lines are not those of ICIDemand', {NOTHING} FROM named WHERE damage = 0 GROUP BY name
UNION ALL SELECT name, 'line ' || (count(*) + 5) || ': unreadable row no row', {NOTHING} FROM named WHERE damage = 1 GROUP BY name""")
def parse_hourly_files(spark, sf):
    return _rows(report_texts.hourly_files(spark, sf))


@register("parse_five_minute_files", f"""WITH slots AS (
  SELECT CAST(ts AS DATE) AS day, hour(ts) AS h, minute(ts) // 5 AS slot, sum(CAST(value AS DECIMAL(18,2))) AS mw FROM events GROUP BY 1, 2, 3),
numbered AS (
  SELECT *, 'PUB_RealtimeTotals_' || strftime(day, '%Y%m%d') || lpad(CAST(h + 1 AS VARCHAR), 2, '0') || '_v1.xml' AS name,
         CASE WHEN day(day) % 4 = 0 THEN slot + 1 ELSE row_number() OVER (PARTITION BY day, h ORDER BY slot) END AS number FROM slots),
judged AS (
  SELECT *, CASE WHEN h % 6 = 2 THEN 'not well-formed' WHEN max(number) OVER (PARTITION BY name) <> count(*) OVER (PARTITION BY name) THEN 'intervals do not count up from 1'
              WHEN h % 6 = 1 THEN 'quantity missing or unreadable' END AS error FROM numbered)
SELECT name, error, day + INTERVAL 5 HOUR + to_hours(h) + to_minutes(5 * (number - 1)) AS interval_start, h + 1 AS hour_ending, CAST(mw AS DOUBLE) AS value_mw,
       CAST(mw + 1000 AS DOUBLE) AS load_mw FROM judged WHERE error IS NULL
UNION ALL SELECT name, error, {NOTHING} FROM judged WHERE error IS NOT NULL GROUP BY name, error""")
def parse_five_minute_files(spark, sf):
    return _rows(report_texts.five_minute_files(spark, sf))


@register("parse_forecast_files", f"""WITH hours AS (
  SELECT CAST(ts AS DATE) AS day, hour(ts) AS h, sum(CAST(value AS DECIMAL(18,2))) AS mw FROM events
  WHERE NOT (day(ts) % 5 = 0 AND hour(ts) = 6) GROUP BY 1, 2),
named AS (SELECT h.*, ext, 'PUB_PredispTotals_' || strftime(day, '%Y%m%d') || '_v1.' || ext AS name FROM hours h, (VALUES ('csv'), ('xml')) e(ext)),
judged AS (
  SELECT *, CASE WHEN day(day) % 5 = 1 AND ext = 'csv' THEN 'load column is missing' WHEN count(*) OVER (PARTITION BY name) <> 24 THEN 'hours do not run from 1 to 24'
              WHEN day(day) % 5 = 1 THEN 'quantity missing or unreadable' END AS error FROM named)
SELECT name, error, day + INTERVAL 5 HOUR + to_hours(h) AS interval_start, h + 1 AS hour_ending, CAST(mw AS DOUBLE) AS value_mw, CAST(mw AS DOUBLE) AS load_mw
FROM judged WHERE error IS NULL
UNION ALL SELECT name, error, {NOTHING} FROM judged WHERE error IS NOT NULL GROUP BY name, error""")
def parse_forecast_files(spark, sf):
    return _rows(report_texts.forecast_files(spark, sf))


@register("listing_entries", f"""WITH {FILES}
SELECT report, name, min(published_at) AS published_at FROM files GROUP BY 1, 2""")
def listing_entries(spark, sf):
    return listing.entries(report_texts.listing_pages(spark, sf)).select("report", "name", "published_at")
