"""Listings, file names, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakledger.functions import names
from peakledger.operators import merge, reconcile
from peakledger.plans.catalog.base import EVENTS, FILES, register
from peakledger.plans.catalog.tables import CURRENT_RANK
from peakledger.sources import listing
from peakledger.sources.feeds import listed_files, table, two_batches, versioned_events

WANTED = r"""((report = 'ICIDemand' AND regexp_matches(name, '_v\d+\.csv$')) OR (report <> 'ICIDemand' AND regexp_matches(name, '_v\d+\.xml$')))"""
GROUP = r"regexp_replace(name, '_v\d+(\.\w+)$', '\1')"
VERSION = r"TRY_CAST(nullif(regexp_extract(name, '_v(\d+)\.\w+$', 1), '') AS BIGINT)"
SINCE, UNTIL = "1997-03-01", "1997-09-01"

CHANGES = f"""{FILES},
listed AS (SELECT report, name, min(published_at) AS published_at FROM files WHERE {WANTED} GROUP BY 1, 2),
done AS (SELECT DISTINCT report, name FROM files WHERE flag = 'A' AND state = 'F' AND {WANTED}
  UNION SELECT DISTINCT report, name FROM files WHERE flag = 'R' AND state = 'O' AND month(published_at) = 3 AND {WANTED}),
missing AS (SELECT *, {GROUP} AS file_group, {VERSION} AS version FROM listed ANTI JOIN done USING (report, name)),
changes AS (
  SELECT m.*, CASE WHEN d.file_group IS NULL THEN 'new_group' ELSE 'new_version' END AS kind
  FROM missing m LEFT JOIN (SELECT DISTINCT report, {GROUP} AS file_group FROM done) d USING (report, file_group))"""


def _wanted(spark, sf):
    return listing.wanted(listed_files(spark, sf))


def _done(files):
    """What the producer finished, and what earlier reconciliations handled in March."""
    finished = files.where((F.col("flag") == "A") & (F.col("state") == "F"))
    handled = files.where((F.col("flag") == "R") & (F.col("state") == "O") & (F.month("published_at") == 3))
    return finished.select("report", "name").unionByName(handled.select("report", "name"))


def _changes(spark, sf):
    files = _wanted(spark, sf)
    return reconcile.find_changes(files, _done(files))


@register("listing_links", """
SELECT page_id, link AS name, count(*) AS copies
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY 1, 2""")
def listing_links(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return listing.links(pages, pattern=listing.ANY_LINK).groupBy("page_id", "name").agg(F.count(F.lit(1)).alias("copies"))


@register("wanted_files", f"""WITH {FILES} SELECT DISTINCT report, name FROM files WHERE {WANTED}""")
def wanted_files(spark, sf):
    return _wanted(spark, sf).select("report", "name").distinct()


@register("files_in_window", f"""WITH {FILES}
SELECT report, name, published_at, count(*) AS copies FROM files
WHERE {WANTED} AND published_at >= TIMESTAMP '{SINCE}' AND published_at < TIMESTAMP '{UNTIL}' GROUP BY 1, 2, 3""")
def files_in_window(spark, sf):
    moment = lambda day: F.lit(day).cast("timestamp_ntz")
    files = reconcile.in_period(_wanted(spark, sf), moment(SINCE), moment(UNTIL))
    return files.groupBy("report", "name", "published_at").agg(F.count(F.lit(1)).alias("copies"))


@register("version_and_group", f"""WITH {FILES}
SELECT report, {GROUP} AS file_group, count(DISTINCT name) AS files, max({VERSION})::DOUBLE AS newest,
       count(DISTINCT CASE WHEN {VERSION} IS NULL THEN name END) AS refused FROM files GROUP BY 1, 2""")
def version_and_group(spark, sf):
    unique = listed_files(spark, sf).select("report", "name").distinct()
    version = names.version_of(F.col("name"))
    return unique.groupBy("report", names.group_of(F.col("name")).alias("file_group")).agg(
        F.count(F.lit(1)).alias("files"), F.max(version).cast("double").alias("newest"), F.count_if(version.isNull()).alias("refused"))


@register("files_to_archive", f"""WITH {FILES}
SELECT DISTINCT report, name FROM files WHERE {WANTED}
EXCEPT SELECT report, name FROM files WHERE state = 'F'""")
def files_to_archive(spark, sf):
    files = listed_files(spark, sf)
    held = files.where(F.col("state") == "F")
    return reconcile.missing_files(listing.wanted(files), held).select("report", "name")


@register("reconcile_missing", f"WITH {CHANGES} SELECT report, name, published_at FROM missing")
def reconcile_missing(spark, sf):
    files = _wanted(spark, sf)
    return reconcile.missing_files(files, _done(files)).select("report", "name", "published_at")


@register("reconcile_kinds", f"WITH {CHANGES} SELECT report, name, file_group, version, kind FROM changes")
def reconcile_kinds(spark, sf):
    return _changes(spark, sf).select("report", "name", "file_group", "version", "kind")


@register("reconcile_summary", f"""WITH {CHANGES}
SELECT report, (SELECT count(*) FROM listed l WHERE l.report = c.report) AS listed,
       count(*) FILTER (WHERE kind = 'new_group') AS new_group, count(*) FILTER (WHERE kind = 'new_version') AS new_version
FROM changes c GROUP BY 1""")
def reconcile_summary(spark, sf):
    files = _wanted(spark, sf)
    return reconcile.summarize(reconcile.find_changes(files, _done(files)), files)


@register("newest_complete_group", f"""WITH {FILES}, mine AS (SELECT DISTINCT name, {GROUP} AS file_group FROM files WHERE report = 'RealtimeTotals' AND {WANTED}),
full_groups AS (SELECT file_group, regexp_extract(file_group, '_(\\d{{10}})\\.', 1) AS stamp FROM mine GROUP BY 1
                HAVING count(*) >= 12 AND stamp <= '2000062100')
SELECT file_group, name FROM mine WHERE file_group = (SELECT arg_max(file_group, (stamp, file_group)) FROM full_groups)""")
def newest_complete_group(spark, sf):
    return reconcile.newest_complete_group(_wanted(spark, sf), "2000062100")


@register("landed_count", f"""WITH {EVENTS},
current AS (SELECT * FROM (SELECT * FROM feed WHERE ingested_at < TIMESTAMP '1998-01-01') QUALIFY row_number() OVER ({CURRENT_RANK}) = 1)
SELECT count(*) AS events_landed FROM feed k JOIN current c USING (report, interval_start, zone)
WHERE k.ingested_at >= TIMESTAMP '1998-01-01' AND c.version >= k.version""")
def landed_count(spark, sf):
    """Events sent since 1998 that a table ending in 1997 already reflects."""
    one, two = two_batches(versioned_events(spark, sf))
    return reconcile.landed(two, merge.latest_versions(one))


@register("republish_summary", f"""WITH {CHANGES}, {EVENTS}
SELECT (SELECT count(*) FROM changes WHERE version % 5 <> 0) AS files_processed, (SELECT count(*) FROM changes WHERE version % 5 = 0) AS files_failed,
       count(*) AS events_sent, count(DISTINCT source_uri) AS files_with_new_values FROM feed WHERE reason = 'reconciliation'""")
def republish_summary(spark, sf):
    """Every fifth version stands for a file that failed to parse."""
    outcomes = _changes(spark, sf).select("report", "name", (F.col("version") % 5 != 0).alias("ok"))
    sent = versioned_events(spark, sf).where(F.col("reason") == "reconciliation")
    return reconcile.republish_summary(outcomes, sent)
