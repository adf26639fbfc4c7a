"""The tables the jobs write: plain Parquet, appended to and partitioned by the UTC day of the reading.

Nothing is ever changed in place. Every row carries the instant of its write, and readers resolve what they find: the first of a
raw key, the newest version of an interval, the last row of a run. Deletes are rows too, which hide what was written before them.
So a write that is tried again, whole or in part, changes nothing. Progress is kept by the streams' own checkpoints.
One writer a table at a time, as Spark's appends ask. With a lakehouse catalog its own MERGE would take this module's place.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.functions.events import CURRENT_KEY, RUN_SCHEMA, SIGNAL_SCHEMA, TABLE_SCHEMA
from peakledger.operators import merge

RAW, CURRENT, SIGNALS, RUNS = "raw_demand_versions", "current_demand", "signals", "reconciliation_runs"
STATE, DONE, HANDLED, REMOVED = "producer_state", "done_files", "handled_files", "removed_rows"

# table -> (schema, column the day partition is taken from)
TABLES = {
    RAW: (TABLE_SCHEMA, "interval_start"),
    CURRENT: (TABLE_SCHEMA, "interval_start"),
    SIGNALS: (SIGNAL_SCHEMA, "candidate_hour"),
    RUNS: (RUN_SCHEMA, "data_interval_start"),
    STATE: ("report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double", "interval_start"),
    DONE: ("report string, name string, published_at timestamp_ntz", "published_at"),
    HANDLED: ("report string, name string, published_at timestamp_ntz", "published_at"),
    REMOVED: ("table_name string, report string, name string, interval_start timestamp_ntz", "interval_start"),
}
# What a row of REMOVED names, by table.
REMOVABLE = {RAW: ["report", "interval_start"], CURRENT: ["report", "interval_start"], STATE: ["report", "interval_start"], DONE: ["report", "name"]}
FIRST, LAST = date(1000, 1, 1), date(9999, 12, 31)


def days_of(rows: DataFrame, moment: str) -> DataFrame:
    """The days of a batch, one row each. The calendar bounds them (3.3 million from FIRST to LAST, 4 bytes each), so they can be broadcast."""
    return rows.select(F.col(moment).cast("date").alias("day")).where(F.col("day").between(F.lit(FIRST), F.lit(LAST))).distinct()


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    # ---- reading ----

    def _stored(self, table: str) -> DataFrame:
        schema = f"{TABLES[table][0]}, written_at timestamp_ntz, day date"
        path = f"{self.root}/{table}"
        return self.spark.read.schema(schema).parquet(path) if self._exists(path) else self.spark.createDataFrame([], schema)

    def rows(self, table: str, first: date = FIRST, last: date = LAST, days: DataFrame | None = None, written: bool = False) -> DataFrame:
        """All rows of the days that no later removal hides, as appended; ``written`` keeps the instant of the write.

        The conditions on days are on the partition column: other days are not read. ``days`` (column day, from ``days_of``) is joined to
        it, so Spark finds out at run time which partitions there are to read.
        """
        found = self._stored(table).where(F.col("day").between(F.lit(first), F.lit(last)))
        if days is not None:
            found = found.join(F.broadcast(days), "day", "left_semi")
        if table in REMOVABLE and self._exists(f"{self.root}/{REMOVED}"):
            keys = REMOVABLE[table]
            gone = self._stored(REMOVED).where(F.col("table_name") == table).groupBy(*keys).agg(F.max("written_at").alias("gone_at"))
            found = found.join(gone, keys, "left").where(F.col("gone_at").isNull() | (F.col("written_at") > F.col("gone_at"))).drop("gone_at")
        names = self.spark.createDataFrame([], TABLES[table][0]).columns
        return found.select(*names, *(["written_at"] if written else []))

    def raw(self, first: date = FIRST, last: date = LAST) -> DataFrame:
        """One row per interval and version: writes leave out what is there, and of what a broken write left twice one counts."""
        return merge.first_versions(self.rows(RAW, first, last))

    def current(self, first: date = FIRST, last: date = LAST) -> DataFrame:
        """One row per interval: a write adds only rows that beat the earlier ones."""
        return merge.latest_versions(self.rows(CURRENT, first, last))

    def signals(self) -> DataFrame:
        return self.rows(SIGNALS)

    def runs(self) -> DataFrame:
        """One row per run_key, the one written last."""
        return merge.best(self.rows(RUNS, written=True), ["run_key"], ["-written_at"]).drop("written_at")

    def state(self, first: date = FIRST, last: date = LAST) -> DataFrame:
        """The producer's last (version, value) per interval."""
        return merge.best(self.rows(STATE, first, last, written=True), CURRENT_KEY, ["-written_at"]).drop("written_at")

    # ---- writing ----

    def append(self, parts: dict[str, DataFrame]) -> None:
        """``parts``: table -> rows, written one after the other under one instant."""
        now = F.lit(utc_now()).cast("timestamp_ntz")
        for table, rows in parts.items():
            schema, moment = TABLES[table]
            names = self.spark.createDataFrame([], schema).columns
            dated = rows.select(*names, now.alias("written_at"), F.col(moment).cast("date").alias("day"))
            # Few files per day: rows are brought together by day, and a day that holds much is split again at run time.
            # Sorted by report and zone within, so that row groups can be skipped.
            clustered = dated.hint("rebalance", "day").sortWithinPartitions("day", *[c for c in ("report", "zone") if c in names])
            clustered.write.mode("append").partitionBy("day").option("compression", "zstd").parquet(f"{self.root}/{table}")

    def write_batch(self, batch: DataFrame) -> bool:
        """Merge a batch of events into both demand tables. False if there was nothing to do.

        A batch that comes again changes nothing: the merges add only rows that are missing or newer. Of the stored tables only the
        batch's own days are read, and of those only the batch's keys are ranked. An event without a full key is refused, as no
        day would show it.
        """
        if not batch.where(" OR ".join(f"{c} IS NULL" for c in (*CURRENT_KEY, "version"))).isEmpty():
            raise ValueError("an event without report, interval, zone or version")
        loaded = batch if "loaded_at" in batch.columns else batch.withColumn("loaded_at", F.lit(utc_now().replace(microsecond=0)).cast("timestamp_ntz"))
        if loaded.isEmpty():
            return False
        days = days_of(loaded, "interval_start")
        keys = loaded.select(*CURRENT_KEY).distinct()
        held = merge.latest_versions(self.rows(CURRENT, days=days).join(keys, CURRENT_KEY, "left_semi"))
        # Raw first: a write that ends between the two is completed by the next try.
        self.append({RAW: merge.new_raw_rows(self.rows(RAW, days=days), loaded)})
        self.append({CURRENT: merge.new_current_rows(held, loaded)})
        return True

    def unannounced(self, rows: DataFrame) -> DataFrame:
        """Decisions that the table of signals does not hold yet, each once."""
        return merge.new_signals(self.rows(SIGNALS, days=days_of(rows, "candidate_hour")), rows)

    def write_signals(self, rows: DataFrame) -> None:
        """Insert decisions that are not in the table yet."""
        self.append({SIGNALS: self.unannounced(rows)})

    def record_run(self, row: DataFrame) -> None:
        """Add a run's row; a rerun's row takes the place of the earlier one."""
        self.append({RUNS: row})

    def _remove(self, tables: list[str], report: str, rows: DataFrame) -> None:
        """``rows``: name or interval_start. What the tables hold of them now is hidden from here on."""
        named = rows.withColumns({c: F.lit(None).cast(t) for c, t in (("name", "string"), ("interval_start", "timestamp_ntz")) if c not in rows.columns})
        each = named.withColumns({"report": F.lit(report), "table_name": F.explode(F.array(*[F.lit(t) for t in tables]))})
        self.append({REMOVED: each})

    def delete_intervals(self, report: str, starts: DataFrame) -> None:
        """Remove a report's rows at the given starts from both demand tables."""
        self._remove([RAW, CURRENT], report, starts.select("interval_start").distinct())

    def forget(self, report: str, files: DataFrame, starts: DataFrame) -> None:
        """Make the producer forget files (report, name) and intervals, so that it would send them again."""
        self._remove([DONE], report, files.select("name").distinct())
        self._remove([STATE], report, starts.select("interval_start").distinct())

    def truncate(self) -> None:
        """Empty both demand tables, for a clean replay."""
        for table in (RAW, CURRENT):
            schema = f"{TABLES[table][0]}, written_at timestamp_ntz, day date"
            self.spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("day").parquet(f"{self.root}/{table}")
