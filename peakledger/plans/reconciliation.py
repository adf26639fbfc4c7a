"""The nightly run: find what was published but not processed, archive it, send it, verify it landed, record the run, check quality."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.functions.events import RUN_SCHEMA
from peakledger.operators import merge, quality, reconcile
from peakledger.plans import ingest
from peakledger.sources import files as landed, reports
from peakledger.streaming.warehouse import DONE, HANDLED, Warehouse

LOOKBACK = timedelta(days=30)  # fixed value: hourly files stay listed for about a month


def detect(listed: DataFrame, warehouse: Warehouse, until: datetime) -> tuple[DataFrame, DataFrame]:
    """(changes, files listed in the period). The period comes from the run, never from the clock."""
    period = reconcile.in_period(listed, F.lit(until - LOOKBACK).cast("timestamp_ntz"), F.lit(until).cast("timestamp_ntz"))
    done = reconcile.done_files(warehouse.rows(DONE), warehouse.rows(HANDLED))
    return reconcile.find_changes(period, done), period


def run(spark: SparkSession, listed: DataFrame, warehouse: Warehouse, topic_root: str, start: datetime, end: datetime,
        recorded_at: datetime, archive: str | None = None, held: DataFrame | None = None, deliver=None) -> dict:
    """``listed``: report, name, published_at, uri of everything published. ``deliver()`` waits until the consumer has caught up.

    The run is recorded and the quality checks run even when a step before them fails. Files become handled only once every
    event sent is in the current table. Returns the run row, the quality counts, and the failure if there was one.
    """
    row = dict.fromkeys(["listed_files", "new_group_files", "new_version_files", "files_processed", "files_failed",
                         "files_with_new_values", "events_sent", "events_landed"], 0)
    by_report, arrived, failure, result = {}, False, None, None
    changes = None
    try:
        changes, period = detect(listed, warehouse, end)
        changes = changes.persist()
        summary = {r["report"]: r for r in reconcile.summarize(changes, period).collect()}  # one row per report
        by_report = {k: {"new_group": r["new_group"], "new_version": r["new_version"]} for k, r in sorted(summary.items())
                     if r["new_group"] or r["new_version"]}
        row["listed_files"] = sum(r["listed"] for r in summary.values())
        row["new_group_files"] = sum(r["new_group"] for r in summary.values())
        row["new_version_files"] = sum(r["new_version"] for r in summary.values())
        wanted = listed.groupBy("report", "name").agg(F.min_by("uri", "published_at").alias("uri")).join(
            changes.select("report", "name", "published_at"), ["report", "name"])
        if archive is not None:
            landed.archive(wanted, held, archive)
        # Topics only grow: a second run of an interval sends next to the first, and merging twice changes nothing.
        key = start.strftime("%Y%m%dT%H%M%S")
        result = ingest.run(wanted, warehouse, topic_root, "reconciliation", recorded_at, f"reconcile-{key}-{uuid.uuid4().hex}", remember=False)
        outcomes = result["outcomes"].select("report", "name", (F.col("outcome") == "files_parsed").alias("ok"))
        row.update(reconcile.republish_summary(outcomes, result["news"]).first().asDict())
        if deliver is not None:
            deliver()
        arrived = row["events_sent"] == 0  # nothing new was sent, so there is nothing to wait for
        if not arrived:
            lo, hi = merge.day_bounds(result["news"])
            hits = reconcile.landed(result["news"], warehouse.current(lo.date(), hi.date())).first()["events_landed"]
            arrived = hits == row["events_sent"]
        row["events_landed"] = row["events_sent"] if arrived else 0
        if arrived:
            finished = result["outcomes"].where(F.col("outcome") == "files_parsed").select("report", "name", "published_at")
            warehouse.append({HANDLED: finished})
    except Exception as err:  # noqa: BLE001 - recorded below, and returned to the caller
        failure = err
    finally:
        status = "ok" if arrived and not row["files_failed"] and failure is None else "needs_attention"
        full = {"run_key": start.isoformat(), "data_interval_start": start, "data_interval_end": end, **row, "status": status,
                "by_report": str(by_report), "recorded_at": recorded_at}
        fields = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
        warehouse.record_run(spark.createDataFrame([tuple(full[f] for f in fields)], RUN_SCHEMA))
        checks = {r["check"]: r["violations"] for r in quality.report(warehouse.raw(), warehouse.current()).collect()}
        for cached in ([changes] if changes is not None else []) + (result["cached"] if result else []):
            cached.unpersist()
    return {"run": full, "quality": checks, "failure": failure}


def seed(warehouse: Warehouse, cutoff: str, files: DataFrame, read=landed.read_texts) -> None:
    """Make everything forget one complete hour, as if it had been missed: the producer its files and intervals, the demand tables
    its rows. Used to try the reconciliation end to end. ``files``: report, name, published_at, uri of the landed files."""
    chosen = reconcile.newest_complete_group(warehouse.rows(DONE), cutoff).select("name")
    mine = files.where(F.col("report") == "RealtimeTotals").join(chosen, "name", "left_semi")
    starts = reports.parse(read(mine)).where(F.col("error").isNull()).select(F.explode("rows").alias("r")).select(
        F.col("r.interval_start").alias("interval_start")).distinct().persist()
    names = chosen.persist()
    try:
        warehouse.delete_intervals("RealtimeTotals", starts)
        warehouse.forget("RealtimeTotals", names, starts)
    finally:
        starts.unpersist()
        names.unpersist()
