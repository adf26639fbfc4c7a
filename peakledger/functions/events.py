"""Fields of a demand event that follow from its report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from peakledger.functions import clock
from peakledger.functions.names import lookup

# Topic, and what the number means, per report.
TOPIC = {
    "RealtimeTotals": "ieso.demand.realtime",
    "PredispTotals": "ieso.demand.predispatch",
    "ICIDemand": "ieso.demand.ici",
}
MEASURE = {
    "RealtimeTotals": "ontario_demand",
    "PredispTotals": "total_load",
    "ICIDemand": "ontario_demand",
}
ZONE = "ONTARIO"
REASONS = ("live", "backfill", "reconciliation")

# The instant comes first because sorts compare the first key first, and reports and zones repeat a great deal.
CURRENT_KEY = ["interval_start", "report", "zone"]
RAW_KEY = [*CURRENT_KEY, "version"]

EVENT_COLUMNS = ["report", "measure", "interval_start", "zone", "version", "value_mw", "published_at",
                 "ingested_at", "source_uri", "content_sha256", "reason"]
TABLE_SCHEMA = ("report string, measure string, interval_start timestamp_ntz, zone string, version bigint, "
                "value_mw double, published_at timestamp_ntz, ingested_at timestamp_ntz, loaded_at timestamp_ntz, "
                "source_uri string, content_sha256 string, reason string")
SIGNAL_SCHEMA = ("zone string, variant string, candidate_hour timestamp_ntz, decided_at timestamp_ntz, risk boolean, "
                 "reason string, estimate_mw double, bar_mw double, margin double, notice_hours double, "
                 "evaluated_at timestamp_ntz")
RUN_SCHEMA = ("run_key string, data_interval_start timestamp_ntz, data_interval_end timestamp_ntz, listed_files bigint, "
              "new_group_files bigint, new_version_files bigint, files_processed bigint, files_failed bigint, "
              "files_with_new_values bigint, events_sent bigint, events_landed bigint, status string, by_report string, "
              "recorded_at timestamp_ntz")


def topic(report: Column) -> Column:
    return lookup(TOPIC, report)


def measure(report: Column) -> Column:
    return lookup(MEASURE, report)


def routing_key(report: Column, zone: Column, start: Column) -> Column:
    """All versions of one interval share a key; different market days spread out."""
    return F.concat_ws("|", report, zone, clock.est_day(start).cast("string"))


def wire(columns=None) -> Column:
    """The event as the flat JSON object that goes on the wire."""
    fields = [F.lit(1).alias("schema_version")]
    for name in columns or EVENT_COLUMNS:
        moment = name in ("interval_start", "published_at", "ingested_at")
        fields.append((clock.iso(F.col(name)) if moment else F.col(name)).alias(name))
    return F.to_json(F.struct(*fields))
