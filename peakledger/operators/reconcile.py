"""What was published against what was processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from peakledger.functions import names

COMPLETE_GROUP = 12   # fixed value: a full hour has twelve versions


def in_period(files: DataFrame, since, until) -> DataFrame:
    """Published in [since, until)."""
    return files.where((F.col("published_at") >= F.lit(since)) & (F.col("published_at") < F.lit(until)))


def done_files(*tables: DataFrame) -> DataFrame:
    """Union of the processed and the previously handled files, each (report, name) once."""
    out = tables[0].select("report", "name")
    for table in tables[1:]:
        out = out.unionByName(table.select("report", "name"))
    return out.distinct()


def missing_files(listed: DataFrame, done: DataFrame) -> DataFrame:
    """Listed but never processed, each name once. One grouping of both tables, combined on the map side, tells what is done."""
    both = listed.select("report", "name", "published_at", F.lit(0).alias("_done")).unionByName(
        done.select("report", "name", F.lit(None).cast("timestamp_ntz").alias("published_at"), F.lit(1).alias("_done")))
    return (both.groupBy("report", "name").agg(F.min("published_at").alias("published_at"), F.max("_done").alias("_done"))
            .where(F.col("_done") == 0).drop("_done"))


def find_changes(listed: DataFrame, done: DataFrame) -> DataFrame:
    """Missing files with their kind: ``new_version`` if some version of the group is done, else ``new_group``.

    A group may hold a great many missing versions: a plain join, which adaptive execution splits where a group is large.
    """
    group = names.group_of(F.col("name")).alias("file_group")
    missing = missing_files(listed, done).select("report", "name", "published_at", group,
                                                 names.version_of(F.col("name")).alias("version"))
    marks = done.select("report", group).distinct().withColumn("_done", F.lit(True))
    marked = missing.join(marks, ["report", "file_group"], "left")
    return marked.withColumn("kind", F.when(F.col("_done"), "new_version").otherwise("new_group")).drop("_done")


def oldest_first(changes: DataFrame) -> DataFrame:
    """Group, then version as a number: v9 before v10. A distributed range sort."""
    return changes.orderBy("report", "file_group", "version")


def summarize(changes: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Per report: listed, new_group, new_version."""
    by_kind = changes.groupBy("report").agg(
        F.count_if(F.col("kind") == "new_group").alias("new_group"),
        F.count_if(F.col("kind") == "new_version").alias("new_version"))
    if listed is None:
        return by_kind
    counts = listed.select("report", "name").distinct().groupBy("report").agg(F.count(F.lit(1)).alias("listed"))
    return counts.join(by_kind, "report", "left").na.fill(0, ["new_group", "new_version"])


def landed(sent: DataFrame, current: DataFrame) -> DataFrame:
    """How many sent events the current table reflects: its version is at least the sent one. All are checked.

    Both sides are counted per (key, version) first, so copies of one event cost one row.
    """
    key = ["report", "interval_start", "zone"]
    asked = sent.groupBy(*key, F.col("version").alias("_sent")).agg(F.count(F.lit(1)).alias("_n"))
    held = current.groupBy(*key, "version").agg(F.count(F.lit(1)).alias("_held"))
    hits = asked.join(held, key).where(F.col("version") >= F.col("_sent"))
    return hits.agg(F.coalesce(F.sum(F.col("_n") * F.col("_held")), F.lit(0)).cast("bigint").alias("events_landed"))


def grouped_names(done: DataFrame, report: str) -> DataFrame:
    """name, file_group: each name once. The group is made from an aggregate, so a filter on it stays above the exchange: no
    pattern runs on repeated rows, and all uses of this frame in one plan share the exchange."""
    once = done.where(F.col("report") == report).groupBy("name").agg(F.max("name").alias("_name"))
    return once.select("name", names.group_of(F.col("_name")).alias("file_group"))


def complete_groups(done: DataFrame, report: str = "RealtimeTotals") -> DataFrame:
    """file_group, stamp, files for groups that have every version."""
    counts = grouped_names(done, report).groupBy("file_group").agg(F.count(F.lit(1)).alias("files"))
    return counts.where(F.col("files") >= COMPLETE_GROUP).withColumn("stamp", names.stamp_of(F.col("file_group")))


def newest_complete_group(done: DataFrame, cutoff: str, report: str = "RealtimeTotals") -> DataFrame:
    """The files (one row each) of the newest complete group whose stamp is not after ``cutoff`` (yyyyMMddHH)."""
    chosen = (complete_groups(done, report).where(F.col("stamp") <= cutoff)
              .agg(F.max_by("file_group", F.struct("stamp", "file_group")).alias("g")).select("g"))
    return grouped_names(done, report).where(F.col("file_group") == chosen.scalar()).select("file_group", "name")


def to_json(changes: DataFrame) -> DataFrame:
    """One JSON text per change, for hand-over between jobs."""
    return changes.select(F.to_json(F.struct(
        "report", "name", F.col("published_at").cast("string").alias("published_at"),
        "kind")).alias("value"))


def from_json(lines: DataFrame) -> DataFrame:
    parsed = F.from_json("value", "report string, name string, published_at string, kind string")
    return lines.select(parsed.alias("c")).select(
        "c.report", "c.name", F.col("c.published_at").cast("timestamp_ntz").alias("published_at"), "c.kind")


def republish_summary(outcomes: DataFrame, sent: DataFrame) -> DataFrame:
    """processed, failed, events_sent, files_with_new_values in one row.

    ``outcomes``: report, name, ok. ``sent``: events with their source_uri.
    """
    files = outcomes.agg(F.count_if("ok").alias("files_processed"), F.count_if(~F.col("ok")).alias("files_failed"))
    events = sent.agg(F.count(F.lit(1)).alias("events_sent"), F.count_distinct("source_uri").alias("files_with_new_values"))
    # Two one-row aggregates side by side.
    return files.select("files_processed", "files_failed", events.select("events_sent").scalar().alias("events_sent"),
                        events.select("files_with_new_values").scalar().alias("files_with_new_values"))
