"""Directory listings: names and publish times out of index pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from peakledger.functions import clock, names

# Fixed pattern of a listing line: link to a report file, then its time in market time.
ENTRY = r'<a href="(PUB_[^"]+)">[^<]*</a>\s+(\d{2}-\w{3}-\d{4} \d{2}:\d{2})'
LINK = r'href="(PUB_[^"]+)"'
ANY_LINK = r'href="([^"]*)"'


def links(pages: DataFrame, html: str = "html", pattern: str = LINK) -> DataFrame:
    """One row per link: the page's other columns, and ``name``."""
    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), 1)).alias("name"))


def entries(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per listed file: the page's other columns, ``name`` and ``published_at`` in UTC."""
    others = [c for c in pages.columns if c != html]
    parts = [F.regexp_extract_all(F.col(html), F.lit(ENTRY), i) for i in (1, 2)]
    rows = pages.select(*others, F.explode(F.arrays_zip(parts[0].alias("name"), parts[1].alias("at"))).alias("e"))
    return rows.select(*others, F.col("e.name").alias("name"),
                       (_listing_time(F.col("e.at")) + clock.hours(5)).alias("published_at"))


def _listing_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit("dd-MMM-yyyy HH:mm"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Index pages stored as root/<report>/<page>.html: report, html. The pages are Latin-1."""
    raw = spark.read.format("binaryFile").load(path)
    report = F.element_at(F.split("path", "/"), -2)
    return raw.select(report.alias("report"), F.decode("content", "ISO-8859-1").alias("html"))


def wanted(files: DataFrame) -> DataFrame:
    return files.where(names.is_wanted(F.col("report"), F.col("name")))
