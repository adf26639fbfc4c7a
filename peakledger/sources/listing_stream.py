"""Index pages as a stream: each batch lists the files published since the last one.

The offset is an instant, so nothing that was listed is kept or compared, and neither the driver nor the checkpoint grows with the number
of files. Each report's page is read and filtered by a task. Pages give whole minutes, and an entry may show up a little after the
minute it names: a batch ends ``settle_minutes`` before the present, so a minute is final when it is taken. An entry that shows up later
still is left to the reconciliation. A batch that is tried again lists the same span, whatever was added to the page since.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from peakledger.functions import names
from peakledger.functions.shipping import by_value
from peakledger.sources.files import FILE, place_of, read_texts
from peakledger.sources.listing import ENTRY

by_value(__name__)

SOURCE, PAGE = "report_listing", "index.html"
SETTLE_MINUTES = 2
EPOCH = datetime(1970, 1, 1)


def minutes_of(moment: datetime) -> int:
    """Whole minutes since 1970 of a naive UTC instant."""
    return int((moment - EPOCH).total_seconds() // 60)


def entries_of(page: str) -> Iterator[tuple[str, datetime]]:
    """(name, published in UTC) of the page's entries, each once; a time that is none is passed over."""
    seen = set()
    for name, stamp in re.findall(ENTRY, page):
        try:
            published = datetime.strptime(stamp, "%d-%b-%Y %H:%M") + timedelta(hours=5)
        except ValueError:
            continue
        if (name, published) not in seen:
            seen.add((name, published))
            yield name, published


def fetch(uri: str) -> bytes:
    from pyarrow import fs
    store, path = place_of(uri)
    if store == "file:///":
        system = fs.LocalFileSystem()
    else:
        system, base = fs.FileSystem.from_uri(f"{store}/")
        path = f"{base.rstrip('/')}/{path}"
    with system.open_input_stream(path) as stream:
        return stream.read()


class Span(InputPartition):
    """One report's entries after ``start`` and up to ``end``, in minutes."""

    def __init__(self, report: str, start: int, end: int) -> None:
        self.report, self.start, self.end = report, start, end


class ListingReader(DataSourceStreamReader):
    def __init__(self, root: str, reports: list[str], since: int, settle: int) -> None:
        self.root, self.reports, self.since, self.settle = root, reports, since, settle
        self.latest = since

    def initialOffset(self) -> dict:
        return {"minute": self.since}

    def latestOffset(self) -> dict:
        now = minutes_of(datetime.fromtimestamp(time.time(), timezone.utc).replace(tzinfo=None))
        self.latest = max(self.latest, now - self.settle)  # a clock set back lists nothing twice
        return {"minute": self.latest}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return [Span(r, start["minute"], end["minute"]) for r in self.reports]

    def read(self, partition: Span) -> Iterator[tuple]:
        page = fetch(f"{self.root}/{partition.report}/{PAGE}").decode("ISO-8859-1")
        for name, published in entries_of(page):
            if partition.start < minutes_of(published) <= partition.end:
                yield partition.report, name, published, f"{self.root}/{partition.report}/{name}"


class ListingSource(DataSource):
    """Options: path, reports (comma-separated), since_minute, settle_minutes."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return FILE

    def streamReader(self, schema) -> ListingReader:
        o = self.options
        return ListingReader(o["path"], o["reports"].split(","), int(o["since_minute"]), int(o["settle_minutes"]))


def listed(spark: SparkSession, root: str, reports=names.EVENT_REPORTS, since: datetime = EPOCH,
           settle_minutes: int = SETTLE_MINUTES) -> DataFrame:
    """Stream of report, name, published_at, uri of the wanted files published after ``since`` (UTC), by root/<report>/index.html.

    A page that cannot be read stops the batch, which is then tried again: no file is passed over. ``reports`` may repeat.
    """
    spark.dataSource.register(ListingSource)
    place = root.rstrip("/") if re.match(r"\w[\w+.-]*:/", root) else f"file://{root.rstrip('/')}"
    rows = (spark.readStream.format(SOURCE).option("reports", ",".join(dict.fromkeys(reports))).option("since_minute", minutes_of(since))
            .option("settle_minutes", settle_minutes).load(place))
    return rows.where(names.is_wanted(F.col("report"), F.col("name")))


def file_stream(spark: SparkSession, root: str, **options) -> DataFrame:
    """``listed``, with the text of each file, fetched by the tasks that hold the names."""
    return read_texts(listed(spark, root, **options))
