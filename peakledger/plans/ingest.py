"""Report files to events: skip what is done, parse, keep what is news, check the contract, send, remember."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from peakledger.functions import contract, events
from peakledger.operators import changes
from peakledger.sources import files as landed, reports
from peakledger.streaming import counters, topics
from peakledger.streaming.warehouse import DONE, STATE, Warehouse

FILE_ORDER = ["file_group", "version", "published_at", "source_uri", "value_mw"]  # group, then version as a number


def process(files: DataFrame, state_of, reason: str, ingested_at: datetime) -> dict:
    """``files``: report, name, published_at, uri, text. ``state_of(first, last)`` reads the producer state of those days.

    Returns parsed (kept in memory and on disk until unpersisted), events, news, outcomes, and tally: files and events per report and
    outcome, counted in the pass that finds the days.
    """
    parsed = reports.parse(files).persist()  # one read and one parse for all that follows
    found = reports.to_events(parsed, reason, F.lit(ingested_at).cast("timestamp_ntz"))
    good = F.col("error").isNull()
    verdict = F.when(good, "files_parsed").otherwise("files_failed")
    starts = F.when(good, F.transform("rows", lambda r: r["interval_start"]))
    tally = parsed.groupBy("report", verdict.alias("outcome")).agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.coalesce(F.size(starts), F.lit(0))).alias("events"),
        F.min(F.array_min(starts)).alias("lo"), F.max(F.array_max(starts)).alias("hi"), F.max("published_at").alias("newest")).collect()
    days = [day for r in tally if r["lo"] is not None for day in (r["lo"].date(), r["hi"].date())]
    state = state_of(min(days), max(days)) if days else None
    news = changes.news_in_arrival_order(found, state, order=FILE_ORDER)
    outcomes = parsed.select("report", "name", "published_at", verdict.alias("outcome"), "error")
    return {"parsed": parsed, "events": found, "news": news, "outcomes": outcomes, "tally": tally}


def check(news: DataFrame) -> DataFrame:
    """Per report: events, and those of them that break the contract. The producer must send nothing while there are any."""
    checked = contract.check(news.select("report", events.wire().alias("value")))
    return checked.groupBy("report").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.size("violations") > 0).alias("broken"))


def _counted(tally: list, checked: list) -> list[dict]:
    """Counters per report from the two passes."""
    by_report: dict = {}
    for r in tally:
        row = by_report.setdefault(r["report"], dict.fromkeys(counters.SUMS[:-1], 0) | {"report": r["report"], "newest_published": None})
        row[r["outcome"]] += r["files"]
        row["events_deduplicated"] += max(r["events"], 0)
        if r["outcome"] == "files_parsed":
            row["newest_published"] = r["newest"]
    for r in checked:
        row = by_report[r["report"]]
        row["events_produced"], row["events_invalid"] = r["events"] - r["broken"], r["broken"]
        row["events_deduplicated"] -= r["events"]
    return [by_report[k] for k in sorted(by_report, key=str)]


def deliver(files: DataFrame, warehouse: Warehouse, topic_root: str, reason: str, ingested_at: datetime, batch: str,
            remember: bool = True, kafka: dict | None = None, metrics: str | None = None, skipped: dict | None = None) -> dict:
    """Send the news of these files. Files and state are recorded only after delivery: a crash in between sends again, never loses.

    With ``remember`` off (reconciliation) nothing is recorded, and outcomes and news stay cached for the caller. ``metrics`` names the
    table of counters; ``skipped`` adds to it what was not opened, per report. Events that break the contract stop the batch; they are
    counted as invalid, and nothing as produced.
    """
    begun = time.monotonic()
    out = process(files, warehouse.state, reason, ingested_at)
    news, outcomes = out["news"].persist(), out["outcomes"]
    try:
        counted = _counted(out["tally"], check(news).collect())
        broken = sum(r["events_invalid"] for r in counted)
        if broken:
            for r in counted:
                r["events_produced"] = 0
        else:
            topics.send(topics.routed(news), topic_root, batch, kafka)
            if remember:
                finished = outcomes.where(F.col("outcome") == "files_parsed").select("report", "name", "published_at")
                warehouse.append({STATE: changes.moved_state(news, FILE_ORDER), DONE: finished})
        if metrics:
            rows = counted + [{"report": k} for k in (skipped or {}) if k not in {r["report"] for r in counted}]
            timed = {"batch_seconds": round(time.monotonic() - begun, 3), "measured_at": ingested_at}
            counters.record(warehouse.spark, metrics, f"producer-{reason}", "files", batch,
                            [r | {"files_skipped": (skipped or {}).get(r["report"], 0)} | timed for r in rows])
        if broken:
            raise ValueError(f"{broken} events break the contract; nothing was sent")
        tally = {(r["report"], r["outcome"]): r["files"] for r in out["tally"]}
        return {"events_produced": sum(r["events_produced"] for r in counted), "events_deduplicated": sum(r["events_deduplicated"] for r in counted),
                "files": tally, "outcomes": outcomes, "news": news, "cached": [news, out["parsed"]]}
    finally:
        if remember:
            news.unpersist()
            out["parsed"].unpersist()


def run(listed: DataFrame, warehouse: Warehouse, topic_root: str, reason: str, ingested_at: datetime, batch: str,
        read=landed.read_texts, remember: bool = True, kafka: dict | None = None, metrics: str | None = None) -> dict:
    """One pass of the producer over a listing (report, name, published_at, uri). Files already done are never opened."""
    done = warehouse.rows(DONE).select("report", "name").distinct()
    fresh = listed.join(done, ["report", "name"], "left_anti")
    skipped = {r["report"]: r["count"] for r in listed.join(done, ["report", "name"], "left_semi").groupBy("report").count().collect()}
    result = deliver(read(fresh), warehouse, topic_root, reason, ingested_at, batch, remember, kafka, metrics, skipped)
    for report, n in skipped.items():
        result["files"][(report, "files_skipped")] = n
    return result
