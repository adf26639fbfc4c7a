"""What a report's file name says: version, group, time stamp, and whether we want the file."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The one file format kept per report.
EXTENSION = {"RealtimeTotals": "xml", "PredispTotals": "xml", "ICIDemand": "csv", "ICIPeakTracker": "xml"}
EVENT_REPORTS = ("RealtimeTotals", "PredispTotals", "ICIDemand")


def lookup(table: dict, key: Column) -> Column:
    """A small fixed table as a map literal; null for a key it lacks."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def version_of(name: Column) -> Column:
    """The N of ``..._vN.ext``; null for an unversioned file, which callers must refuse."""
    return F.nullif(F.regexp_extract(name, r"_v(\d+)\.\w+$", 1), F.lit("")).try_cast("bigint")


def group_of(name: Column) -> Column:
    """The name without its version: all versions of one file share it."""
    return F.regexp_replace(name, r"_v\d+(\.\w+)$", "$1")


def is_wanted(report: Column, name: Column) -> Column:
    """Versioned, and in the report's one format. One pattern over both, so that a derived name is worked out once."""
    formats = "|".join(rf"{r}/.*_v\d+\.{ext}" for r, ext in EXTENSION.items())
    return F.concat_ws("/", report, name).rlike(f"^({formats})$")


def stamp_of(group: Column) -> Column:
    """yyyymmddHH in market time, or null."""
    return F.nullif(F.regexp_extract(group, r"_(\d{10})\.", 1), F.lit(""))
