"""Versioned tables: merges, change filters, checksums, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import events, names
from peakledger.functions.events import RAW_KEY
from peakledger.operators import changes, difference, merge
from peakledger.operators.durable import stored
from peakledger.plans.catalog.base import EVENTS, register
from peakledger.sources.feeds import is_early, listed_files, two_batches, versioned_events
from peakledger.plans.catalog.base import FILES

RAW_RANK = "PARTITION BY report, interval_start, zone, version ORDER BY ingested_at, published_at, source_uri, value_mw"
CURRENT_RANK = ("PARTITION BY report, interval_start, zone ORDER BY version DESC, ingested_at DESC, published_at DESC, "
                "source_uri DESC, value_mw DESC")
# Prices hardly ever repeat; in steps of 25,000 a new version often repeats the value before it.
COARSE = f"{EVENTS}, steps AS (SELECT * REPLACE (floor(value_mw / 25000) * 25000 AS value_mw) FROM feed)"
COLUMNS = events.EVENT_COLUMNS
NAMES = ", ".join(COLUMNS)


def in_steps(feed):
    return feed.withColumn("value_mw", (F.floor(F.col("value_mw") / 25000) * 25000).cast("double"))


@register("merge_raw_versions", f"""WITH {EVENTS}
SELECT {NAMES} FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1""")
def merge_raw_versions(spark, sf):
    return merge.first_versions(versioned_events(spark, sf)).select(*COLUMNS)


@register("merge_current", f"""WITH {EVENTS}
SELECT {NAMES} FROM feed QUALIFY row_number() OVER ({CURRENT_RANK}) = 1""")
def merge_current(spark, sf):
    return merge.latest_versions(versioned_events(spark, sf)).select(*COLUMNS)


MERGED = f"""{EVENTS},
one AS (SELECT * FROM feed WHERE ingested_at < TIMESTAMP '1998-01-01'),
two AS (SELECT * FROM feed WHERE ingested_at >= TIMESTAMP '1998-01-01'),
raw1 AS (SELECT * FROM one QUALIFY row_number() OVER ({RAW_RANK}) = 1),
raw2 AS (SELECT * FROM raw1 UNION ALL
  SELECT * FROM (SELECT * FROM two QUALIFY row_number() OVER ({RAW_RANK}) = 1) b
  WHERE NOT EXISTS (SELECT 1 FROM raw1 r WHERE r.report = b.report AND r.interval_start = b.interval_start AND r.zone = b.zone
                    AND r.version = b.version)),
cur1 AS (SELECT * FROM one QUALIFY row_number() OVER ({CURRENT_RANK}) = 1),
win2 AS (SELECT * FROM two QUALIFY row_number() OVER ({CURRENT_RANK}) = 1),
beat AS (SELECT w.* FROM win2 w LEFT JOIN cur1 c USING (report, interval_start, zone)
  WHERE c.version IS NULL OR w.version > c.version OR (w.version = c.version AND w.ingested_at > c.ingested_at)),
cur2 AS (SELECT * FROM beat UNION ALL
  SELECT c.* FROM cur1 c ANTI JOIN beat b USING (report, interval_start, zone))"""


@register("merge_two_batches", f"""WITH {MERGED}
SELECT 'raw' AS table_name, report, interval_start, zone, version, value_mw, ingested_at, source_uri FROM raw2
UNION ALL SELECT 'current', report, interval_start, zone, version, value_mw, ingested_at, source_uri FROM cur2""")
def merge_two_batches(spark, sf):
    one, two = two_batches(versioned_events(spark, sf))
    raw = merge.merge_raw(merge.first_versions(one), two)
    current = merge.merge_current(merge.latest_versions(one), two)
    shown = ["report", "interval_start", "zone", "version", "value_mw", "ingested_at", "source_uri"]
    return (raw.select(F.lit("raw").alias("table_name"), *shown)
            .unionByName(current.select(F.lit("current").alias("table_name"), *shown)))


@register("latest_version", f"""WITH {EVENTS}
SELECT report, interval_start, zone, max(version) AS version, arg_max(value_mw, (version, ingested_at, published_at, source_uri, value_mw))
  AS value_mw FROM feed GROUP BY 1, 2, 3""")
def latest_version(spark, sf):
    return merge.latest_versions(versioned_events(spark, sf)).select("report", "interval_start", "zone", "version", "value_mw")


@register("changed_values_only", f"""WITH {COARSE}, ordered AS (
  SELECT *, lag(value_mw) OVER (PARTITION BY report, interval_start, zone
                                ORDER BY version, ingested_at, published_at, source_uri, value_mw) AS previous_mw FROM steps)
SELECT report, interval_start, zone, version, ingested_at, source_uri, value_mw, previous_mw FROM ordered
WHERE value_mw IS DISTINCT FROM previous_mw""")
def changed_values_only(spark, sf):
    return changes.changed_values(in_steps(versioned_events(spark, sf))).select(
        "report", "interval_start", "zone", "version", "ingested_at", "source_uri", "value_mw", "previous_mw")


# Arrival order as a recursion over each interval's events: the state carries the last version and value that moved it.
@register("news_in_arrival_order", f"""WITH RECURSIVE {COARSE}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY report, interval_start, zone
                               ORDER BY ingested_at, published_at, version, source_uri, value_mw) AS n FROM steps),
walk AS (
  SELECT report, interval_start, zone, n, version, value_mw, ingested_at, source_uri, true AS news, version AS sv, value_mw AS sx
  FROM numbered WHERE n = 1
  UNION ALL
  SELECT e.report, e.interval_start, e.zone, e.n, e.version, e.value_mw, e.ingested_at, e.source_uri, e.value_mw <> w.sx,
         CASE WHEN e.value_mw <> w.sx AND e.version >= w.sv THEN e.version ELSE w.sv END,
         CASE WHEN e.value_mw <> w.sx AND e.version >= w.sv THEN e.value_mw ELSE w.sx END
  FROM walk w JOIN numbered e ON e.report = w.report AND e.interval_start = w.interval_start AND e.zone = w.zone AND e.n = w.n + 1)
SELECT report, interval_start, zone, version, value_mw, ingested_at, source_uri, sv AS state_version, sx AS state_value
FROM walk WHERE news""")
def news_in_arrival_order(spark, sf):
    return changes.news_in_arrival_order(in_steps(versioned_events(spark, sf))).select(
        "report", "interval_start", "zone", "version", "value_mw", "ingested_at", "source_uri", "state_version", "state_value")


@register("silent_restatements", f"""WITH {EVENTS}
SELECT report, interval_start, zone, version, count(DISTINCT value_mw) AS n_values, min(value_mw) AS lowest, max(value_mw) AS highest
FROM feed GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT value_mw) > 1""")
def silent_restatements(spark, sf):
    return changes.silent_restatements(versioned_events(spark, sf))


@register("delete_intervals", f"""WITH {EVENTS},
raw AS (SELECT * FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1)
SELECT r.report, r.zone, count(*) AS n_rows, min(r.interval_start) AS first_start, max(version) AS newest FROM raw r
WHERE NOT (report = 'RealtimeTotals' AND interval_start IN (
  SELECT interval_start FROM feed WHERE report = 'RealtimeTotals' AND reason = 'reconciliation')) GROUP BY 1, 2""")
def delete_intervals(spark, sf):
    feed = versioned_events(spark, sf)
    starts = feed.where((F.col("report") == "RealtimeTotals") & (F.col("reason") == "reconciliation"))
    left = merge.delete_intervals(merge.first_versions(feed), "RealtimeTotals", starts)
    return left.groupBy("report", "zone").agg(F.count(F.lit(1)).alias("n_rows"), F.min("interval_start").alias("first_start"),
                                              F.max("version").alias("newest"))


CHECKSUM = """count(*) AS n, bit_xor(('0x' || substr(md5(concat_ws('|', report, strftime(interval_start, '%Y-%m-%dT%H:%M:%SZ'), zone,
  CAST(version AS VARCHAR), CAST(CAST(value_mw AS DECIMAL(30,6)) AS VARCHAR))), 1, 15))::BIGINT) AS checksum"""


@register("table_checksum", f"""WITH {EVENTS}
SELECT 'raw_demand_versions' AS table_name, {CHECKSUM} FROM (SELECT * FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1)
UNION ALL SELECT 'current_demand', {CHECKSUM} FROM (SELECT * FROM feed QUALIFY row_number() OVER ({CURRENT_RANK}) = 1)""")
def table_checksum(spark, sf):
    feed = versioned_events(spark, sf)
    tables = {"raw_demand_versions": merge.first_versions(feed), "current_demand": merge.latest_versions(feed)}
    raw, current = (merge.checksum(t).select(F.lit(n).alias("table_name"), "n", "checksum") for n, t in tables.items())
    return raw.unionByName(current)


def _compared_sql(name, built, rebuilt):
    return f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {rebuilt}) AS n_rows, count(*) AS differing FROM (
  SELECT {NAMES} FROM (SELECT {NAMES}, 1 AS s FROM {built} UNION ALL SELECT {NAMES}, -1 FROM {rebuilt}) GROUP BY ALL HAVING sum(s) <> 0)"""


@register("replay_equivalence", f"""WITH {MERGED},
short AS (SELECT * FROM feed WHERE NOT (reason = 'reconciliation' AND version = 7)),
raw_all AS (SELECT * FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1), cur_all AS (SELECT * FROM feed QUALIFY row_number() OVER ({CURRENT_RANK}) = 1),
raw_short AS (SELECT * FROM short QUALIFY row_number() OVER ({RAW_RANK}) = 1), cur_short AS (SELECT * FROM short QUALIFY row_number() OVER ({CURRENT_RANK}) = 1)
{_compared_sql('raw_demand_versions', 'raw2', 'raw_all')} UNION ALL {_compared_sql('current_demand', 'cur2', 'cur_all')}
UNION ALL {_compared_sql('raw_demand_versions, events lost', 'raw2', 'raw_short')}
UNION ALL {_compared_sql('current_demand, events lost', 'cur2', 'cur_short')}""")
def replay_equivalence(spark, sf):
    """Tables built in two batches by arrival, against the same rebuilt from zero in one: of all events, and of a topic that lost
    the seventh versions of the reconciliation."""
    feed = versioned_events(spark, sf)
    early, whole = is_early(), ~((F.col("reason") == "reconciliation") & (F.col("version") == 7))
    tables = {"raw": merge.raw_merged(F.col("early")), "current": merge.current_merged(F.col("early")),
              "raw_all": merge.first_held(), "current_all": merge.latest_held(),
              "raw_short": merge.first_held(F.col("whole")), "current_short": merge.latest_held(F.col("whole"))}
    # The merges look at keys and order; the rest of a row is hashed before it travels.
    rows = feed.select(*RAW_KEY, *merge.FIRST_SEEN, early.alias("early"), whole.alias("whole"), *merge.hashes(COLUMNS))
    return merge.compare_held(merge.held(rows, tables), {
        "raw_demand_versions": ("raw", "raw_all"), "current_demand": ("current", "current_all"),
        "raw_demand_versions, events lost": ("raw", "raw_short"), "current_demand, events lost": ("current", "current_short")})


# The topic that lost the reconciliation of January 2000, from its fifth versions on.
LOST = "reason = 'reconciliation' AND version >= 5 AND interval_start < TIMESTAMP '2000-02-01'"
TABLE_PAIRS = f"""{EVENTS}, short AS (SELECT * FROM feed WHERE NOT ({LOST})),
raw_all AS (SELECT * FROM feed QUALIFY row_number() OVER ({RAW_RANK}) = 1), cur_all AS (SELECT * FROM feed QUALIFY row_number() OVER ({CURRENT_RANK}) = 1),
raw_short AS (SELECT * FROM short QUALIFY row_number() OVER ({RAW_RANK}) = 1), cur_short AS (SELECT * FROM short QUALIFY row_number() OVER ({CURRENT_RANK}) = 1)"""


def _surplus_sql(left, right):
    return f"SELECT {NAMES}, CAST(sum(s) AS BIGINT) AS surplus FROM (SELECT {NAMES}, 1 AS s FROM {left} UNION ALL SELECT {NAMES}, -1 FROM {right}) GROUP BY ALL HAVING sum(s) <> 0"


def stored_pairs(spark, sf, columns):
    """Both demand tables of all events and of the topic with losses, in the given columns and ``day``. Most rows are in all four: they
    are stored once, with the tables that hold them, as each table is read twice.

    A column ``row`` is the hash of a whole row, taken before the rows are shuffled: with it, what no merge looks at stays behind.
    """
    short = F.expr(f"NOT ({LOST.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')})")
    feed = versioned_events(spark, sf).withColumns({"short": short, "row": difference.row_hash(COLUMNS)})
    feed = feed.select(*dict.fromkeys([*RAW_KEY, *merge.FIRST_SEEN, "short", *columns]))
    pairs = {"raw_demand_versions": {"raw_all": merge.first_held(), "raw_short": merge.first_held(F.col("short"))},
             "current_demand": {"current_all": merge.latest_held(), "current_short": merge.latest_held(F.col("short"))}}
    tables = {name: table for pair in pairs.values() for name, table in pair.items()}
    rows = merge.held(feed, tables).select(*columns, *tables, F.col("interval_start").cast("date").alias("day"))
    kept = stored(rows, "compared", codec="zstd")
    return {name: [kept.where(table).select(*columns, "day") for table in pair] for name, pair in pairs.items()}


@register("differing_rows", f"""WITH {TABLE_PAIRS}
SELECT 'raw_demand_versions' AS table_name, * FROM ({_surplus_sql('raw_all', 'raw_short')})
UNION ALL SELECT 'current_demand', * FROM ({_surplus_sql('cur_all', 'cur_short')})""")
def differing_rows(spark, sf):
    """The rows in which stored tables differ, named one by one; only days whose sums are unequal are compared."""
    parts = [difference.differing_rows(*pair, COLUMNS).select(F.lit(name).alias("table_name"), *COLUMNS, "surplus")
             for name, pair in stored_pairs(spark, sf, COLUMNS).items()]
    return parts[0].unionByName(parts[1])


def _levels_sql(name, left, right):
    every = f"SELECT *, CAST(interval_start AS DATE) AS day FROM {left} UNION ALL SELECT *, CAST(interval_start AS DATE) FROM {right}"
    off = f"SELECT *, CAST(interval_start AS DATE) AS day FROM ({_surplus_sql(left, right)})"
    keys = {"report": "report", "zone": "(report, zone)", "day": "(report, zone, day)"}
    return " UNION ALL ".join(f"""SELECT '{name}' AS table_name, '{level}' AS level, (SELECT count(DISTINCT {key}) FROM ({every})) AS buckets,
  (SELECT count(DISTINCT {key}) FROM ({off})) AS unequal""" for level, key in keys.items())


@register("difference_levels", f"""WITH {TABLE_PAIRS}
{_levels_sql('raw_demand_versions', 'raw_all', 'raw_short')} UNION ALL {_levels_sql('current_demand', 'cur_all', 'cur_short')}""")
def difference_levels(spark, sf):
    """How many reports, zones and days hold a difference, from sums alone."""
    parts = [difference.levels(difference.compared(*[difference.day_sums(t, ["row"]) for t in pair])).select(F.lit(name).alias("table_name"), "*")
             for name, pair in stored_pairs(spark, sf, ["report", "zone", "row"]).items()]
    return parts[0].unionByName(parts[1])


@register("event_routing", f"""WITH {EVENTS}
SELECT CASE report WHEN 'RealtimeTotals' THEN 'ieso.demand.realtime' WHEN 'PredispTotals' THEN 'ieso.demand.predispatch'
         ELSE 'ieso.demand.ici' END AS topic,
       concat_ws('|', report, zone, CAST(CAST(interval_start - INTERVAL 5 HOUR AS DATE) AS VARCHAR)) AS key,
       count(*) AS n_events, min(version) AS oldest, max(version) AS newest FROM feed GROUP BY 1, 2""")
def event_routing(spark, sf):
    feed = versioned_events(spark, sf)
    key = events.routing_key(F.col("report"), F.col("zone"), F.col("interval_start"))
    return feed.groupBy(events.topic(F.col("report")).alias("topic"), key.alias("key")).agg(
        F.count(F.lit(1)).alias("n_events"), F.min("version").alias("oldest"), F.max("version").alias("newest"))


@register("file_content_hash", f"""WITH {EVENTS}, points AS (
  SELECT 'PUB_' || report || '_' || zone || '_v' || version AS file,
         md5(strftime(interval_start, '%Y-%m-%dT%H:%M:%SZ') || '=' || CAST(CAST(value_mw AS DECIMAL(30,6)) AS VARCHAR)) AS h FROM feed)
SELECT file, count(*) AS n_points, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), CAST(sum(('0x' || substr(h, 1, 15))::HUGEINT) AS VARCHAR),
  CAST(sum(('0x' || substr(h, 16, 15))::HUGEINT) AS VARCHAR))) AS content_hash FROM points GROUP BY 1""")
def file_content_hash(spark, sf):
    from peakledger.operators.content import content_hash
    feed = versioned_events(spark, sf)
    file = F.concat(F.lit("PUB_"), F.col("report"), F.lit("_"), F.col("zone"), F.lit("_v"), F.col("version").cast("string"))
    return content_hash(feed.withColumn("file", file), ["file"])


@register("upsert_run_log", f"""WITH {FILES}, runs AS (
  SELECT strftime(date_trunc('month', published_at), '%Y-%m') || '/' || report AS run_key, flag, count(*) AS listed_files,
         CASE flag WHEN 'A' THEN TIMESTAMP '2002-01-01' WHEN 'N' THEN TIMESTAMP '2002-01-02' ELSE TIMESTAMP '2002-01-03' END AS recorded_at
  FROM files GROUP BY 1, 2)
SELECT run_key, flag, listed_files, recorded_at FROM runs QUALIFY row_number() OVER (PARTITION BY run_key ORDER BY recorded_at DESC) = 1""")
def upsert_run_log(spark, sf):
    """Each month and report is run once per return flag; the flags stand for first run and two reruns."""
    key = F.concat(F.substring(F.col("published_at").cast("string"), 1, 7), F.lit("/"), F.col("report"))
    recorded = names.lookup({"A": "2002-01-01", "N": "2002-01-02", "R": "2002-01-03"}, F.col("flag")).cast("timestamp_ntz")
    runs = (listed_files(spark, sf).groupBy(key.alias("run_key"), "flag").agg(F.count(F.lit(1)).alias("listed_files"))
            .withColumn("recorded_at", recorded))
    first = runs.where(F.col("flag") == "A")
    once = merge.upsert_runs(first, runs.where(F.col("flag") == "R"))
    return merge.upsert_runs(once, runs.where(F.col("flag") == "N"))
