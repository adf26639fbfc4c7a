"""The registry, and the feeds once more as SQL so that each registered query has an independent twin."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    """Put a query under ``name``; ``sql`` is its twin over the given tables."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


# ---- feeds as SQL ----

def hours_sql(zone: str = "l_returnflag") -> str:
    return f"""
points AS (
  SELECT {zone} AS zone,
         date_trunc('day', l_shipdate) + to_hours(CAST(l_partkey % 9 + 15 AS BIGINT)) AS interval_start,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS mw
  FROM lineitem GROUP BY 1, 2)"""


HOURS = hours_sql()
DAILY = """
daily AS (
  SELECT zone, CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS day, max(mw) AS peak, count(*) AS hours,
         arg_min(interval_start, (-mw, interval_start)) AS peak_hour
  FROM points GROUP BY 1, 2)"""
BARS = """
calendar AS (
  SELECT zone, base_year, CAST(unnest(generate_series(make_date(base_year, 5, 1), make_date(base_year + 1, 4, 30),
         INTERVAL 1 DAY)) AS DATE) AS eff_day
  FROM (SELECT DISTINCT zone, year(day - INTERVAL 4 MONTH) AS base_year FROM daily)),
bars AS (
  SELECT c.zone, c.base_year, c.eff_day,
         list_reverse_sort(list(d.peak) FILTER (WHERE d.peak IS NOT NULL)
           OVER (PARTITION BY c.zone, c.base_year ORDER BY c.eff_day
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))[5] AS bar
  FROM calendar c LEFT JOIN daily d ON d.zone = c.zone AND d.day = c.eff_day)"""

EVENTS = """
feed AS (
  SELECT report, CASE WHEN report = 'PredispTotals' THEN 'total_load' ELSE 'ontario_demand' END AS measure,
         TIMESTAMP '2000-01-01 05:00:00' + to_minutes(CAST(l_orderkey % 100000 * 5 AS BIGINT)) AS interval_start,
         'Z' || CAST(l_orderkey // 100000 AS VARCHAR) AS zone, CAST(l_linenumber AS BIGINT) AS version,
         l_extendedprice AS value_mw, l_shipdate - to_hours(CAST(l_suppkey % 72 AS BIGINT)) AS published_at,
         l_shipdate AS ingested_at,
         'raw/' || report || '/PUB_' || report || '_' || l_orderkey || '_v' || l_linenumber || '#' || l_partkey || '-'
           || l_suppkey AS source_uri,
         sha256('PUB_' || report || '_' || l_orderkey || '_v' || l_linenumber) AS content_sha256,
         CASE l_returnflag WHEN 'A' THEN 'live' WHEN 'N' THEN 'backfill' ELSE 'reconciliation' END AS reason
  FROM (SELECT *, ['RealtimeTotals', 'PredispTotals', 'ICIDemand'][l_orderkey % 3 + 1] AS report FROM lineitem))"""

READINGS = """
readings AS (
  SELECT event_type AS report, date_trunc('hour', ts) AS interval_start,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_mw, count(*) AS version, 'ONTARIO' AS zone
  FROM events GROUP BY 1, 2)"""

FILES = """
files AS (
  SELECT report, 'PUB_' || report || '_' || strftime(week, '%Y%m%d%H')
           || CASE WHEN l_tax = 0 THEN '' ELSE '_v' || (l_linenumber + 7 * (l_suppkey % 2)) END
           || CASE WHEN report = 'ICIDemand' THEN '.csv' ELSE '.xml' END AS name,
         hour + to_minutes(CAST(l_orderkey % 60 AS BIGINT)) AS published_at,
         l_linestatus AS state, l_returnflag AS flag
  FROM (SELECT *, ['RealtimeTotals', 'PredispTotals', 'ICIDemand'][l_orderkey % 3 + 1] AS report,
               l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT)) AS hour,
               date_trunc('week', l_shipdate) + to_hours(CAST(l_partkey % 4 * 6 AS BIGINT)) AS week FROM lineitem))"""

SAMPLES = """
samples AS (
  SELECT ts, event_type AS service, user_id % 6 AS partition, value, event_id AS sample_id FROM events)"""


def ratio_sql(top: str, bottom: str, scale: int) -> str:
    """top / bottom rounded half to even at 1/scale, in whole numbers."""
    a, b = f"(({top}) * {scale})::HUGEINT", f"({bottom})::HUGEINT"
    up = f"CASE WHEN 2 * ({a} % {b}) > {b} OR (2 * ({a} % {b}) = {b} AND ({a} // {b}) % 2 = 1) THEN 1 ELSE 0 END"
    return f"(({a} // {b} + {up})::DOUBLE / {scale})"
