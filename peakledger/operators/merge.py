"""Versioned tables: keyed merges, keyed deletes, checksums.

The functions are pure: stored table and batch in, rows out. ``streaming.warehouse`` writes what they return.
``best`` runs as a row_number filter, which Spark cuts down per map task before the shuffle (WindowGroupLimit); that sorts every
map task. Whole topics go through ``held``: rows are shuffled as they come, once for any number of tables, and only intervals
with very many rows are cut down before.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from peakledger.functions import clock
from peakledger.functions.events import CURRENT_KEY, RAW_KEY

# Tie-breakers beyond ingest time only make the outcome repeatable.
FIRST_SEEN = ["ingested_at", "published_at", "source_uri", "value_mw"]
LAST_SEEN = ["-version", "-ingested_at", "-published_at", "-source_uri", "-value_mw"]


BUCKETS = 1 << 16  # of intervals, by hash: their counts are one small row each
FULL = 1_000_000   # a bucket with more rows is cut down per map task before its rows meet
FEWER = 5          # times fewer partitions at most, where map tasks need not sort then


def _order(names: list[str]) -> list[Column]:
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]


def best(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order`` ("-name" sorts downward)."""
    return (df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order))))
            .where(F.col("_rn") == 1).drop("_rn"))


class Held(NamedTuple):
    """The rows of one topic that a table holds: of each key the first in ``order``, among the rows of which ``among`` is true."""
    keys: list[str | Column]
    order: list[Column]
    among: Column


def first_held(among: Column | None = None) -> Held:
    """What ``first_versions`` keeps of the rows of which ``among`` is true."""
    return Held(RAW_KEY, _order(FIRST_SEEN), F.lit(True) if among is None else among)


def latest_held(among: Column | None = None) -> Held:
    """What ``latest_versions`` keeps of the rows of which ``among`` is true."""
    return Held(CURRENT_KEY, _order(LAST_SEEN), F.lit(True) if among is None else among)


def raw_merged(old: Column) -> Held:
    """What ``merge_raw`` makes of the first versions of the rows with ``old`` true and a batch of those with ``old`` false.

    A key with a null is never found in the table, so there both sides keep their own.
    """
    nowhere = reduce(Column.__or__, [F.col(k).isNull() for k in RAW_KEY])
    return Held([*RAW_KEY, F.when(nowhere, old)], [old.desc(), *_order(FIRST_SEEN)], old.isNotNull())


def current_merged(old: Column) -> Held:
    """What ``merge_current`` makes of the latest versions of the rows with ``old`` true and a batch of those with ``old`` false."""
    return Held(CURRENT_KEY, [*_order(LAST_SEEN[:2]), old.desc(), *_order(LAST_SEEN[2:])], old.isNotNull())


def _marked(topic: DataFrame, tables: dict[str, Held], within: list[str]) -> DataFrame:
    """The rows that some table holds, with a boolean column per table; ``within`` names further columns of every key."""
    for name, held in tables.items():
        among = F.coalesce(held.among, F.lit(False))
        rank = F.row_number().over(Window.partitionBy(*held.keys, *within, among).orderBy(*held.order))
        topic = topic.withColumn(name, among & (rank == 1))
    return topic.where(reduce(Column.__or__, [F.col(name) for name in tables]))


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows shuffled by the keys. Above spark.shuffle.sort.bypassMergeThreshold partitions, map tasks sort all they write and spill
    it once more; where that many are not far below the session's partitions, the rows are dealt to no more."""
    spark = rows.sparkSession
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    if most < int(spark.conf.get("spark.sql.shuffle.partitions")) <= FEWER * most:
        return rows.repartition(most, *keys)
    return rows.repartition(*keys)


def _met(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows shuffled by the keys. Hex digests travel as bytes, half as long; any text that the bytes do not give back goes as it is."""
    if "content_sha256" not in rows.columns:
        return _dealt(rows, keys)
    text, digest = F.col("content_sha256"), F.unhex("content_sha256")
    whole = F.lower(F.hex(digest)) == text
    packed = rows.withColumns({"_digest": F.when(whole, digest), "content_sha256": F.when(whole, F.lit(None)).otherwise(text)})
    back = F.coalesce("content_sha256", F.lower(F.hex("_digest")))
    return _dealt(packed, keys).withColumn("content_sha256", back).select(*rows.columns)


def held(topic: DataFrame, tables: dict[str, Held], full: int | None = None) -> DataFrame:
    """The rows of the topic that some table holds, with a boolean column per table that says whether it does.

    One shuffle by interval serves all tables, as every key begins with the interval; no map task sorts. Intervals of buckets with
    more than ``full`` rows are first cut down to what can still be held, per map task, so that no task meets all their copies.
    """
    bucket = F.pmod(F.xxhash64(*CURRENT_KEY), F.lit(BUCKETS)).alias("_bucket")
    many = topic.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > (FULL if full is None else full))
    many = F.broadcast(many.select("_bucket"))  # BUCKETS rows at most
    rows = topic.withColumn("_bucket", bucket)
    cold = rows.join(many, "_bucket", "left_anti")
    hot = rows.join(many, "_bucket", "left_semi").withColumn("_task", F.spark_partition_id())
    cut = _marked(_met(hot, [*CURRENT_KEY, "_task"]), tables, ["_task"])
    return _marked(_met(cold.unionByName(cut.select(*cold.columns)).drop("_bucket"), CURRENT_KEY), tables, [])


def first_versions(batch: DataFrame) -> DataFrame:
    """Each (report, interval, zone, version) once: the first seen wins."""
    return held(batch, {"_held": first_held()}).drop("_held")


def latest_versions(batch: DataFrame) -> DataFrame:
    """Each interval once: newest version, and of equal versions the last seen."""
    return held(batch, {"_held": latest_held()}).drop("_held")


def new_raw_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch to append: first seen per key, and only keys the table lacks."""
    return first_versions(batch).join(stored.select(*RAW_KEY), RAW_KEY, "left_anti")


def new_current_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch winners that are new or beat the stored row: newer version, or same version ingested later."""
    kept = stored.select(*CURRENT_KEY, F.col("version").alias("_v"), F.col("ingested_at").alias("_at"))
    beats = (F.col("_v").isNull() | (F.col("version") > F.col("_v"))
             | ((F.col("version") == F.col("_v")) & (F.col("ingested_at") > F.col("_at"))))
    return latest_versions(batch).join(kept, CURRENT_KEY, "left").where(beats).drop("_v", "_at")


def merge_raw(stored: DataFrame, batch: DataFrame) -> DataFrame:
    return stored.unionByName(new_raw_rows(stored, batch))


def merge_current(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The table after the batch. A stored row stays on a full tie of version and ingest time."""
    both = stored.withColumn("_old", F.lit(1)).unionByName(latest_versions(batch).withColumn("_old", F.lit(0)))
    order = ["-version", "-ingested_at", "-_old", *LAST_SEEN[2:]]
    return best(both, CURRENT_KEY, order).drop("_old")


def insert_once(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows to append so that each key appears once, in the table and in the batch."""
    return best(batch, keys, order).join(stored.select(*keys), keys, "left_anti")


SIGNAL_KEY = ["zone", "variant", "candidate_hour", "decided_at"]


def new_signals(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Sending the same decision twice changes nothing; the first evaluation is kept."""
    return insert_once(stored, batch, SIGNAL_KEY, ["evaluated_at", "-margin"])


def upsert_runs(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per run_key; a rerun replaces its row."""
    return best(stored.unionByName(rows), ["run_key"], ["-recorded_at"])


def delete_intervals(table: DataFrame, report: str, starts: DataFrame) -> DataFrame:
    """The table without the report's rows at the given interval starts (a column ``interval_start``)."""
    gone = starts.select("interval_start").distinct().withColumn("report", F.lit(report))
    return table.join(gone, ["report", "interval_start"], "left_anti")


def day_bounds(batch: DataFrame) -> tuple:
    """(first, last) interval_start of the batch: one row to the driver, used as literals to prune stored partitions."""
    row = batch.agg(F.min("interval_start").alias("lo"), F.max("interval_start").alias("hi")).first()
    return row["lo"], row["hi"]


def fingerprint(columns: list[Column]) -> Column:
    """60 bits of md5 over the joined columns: an engine-independent number."""
    text = F.concat_ws("|", *columns)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def checksum(table: DataFrame) -> DataFrame:
    """Row count and order-independent checksum: equal data gives an equal pair, in any order and partitioning."""
    row = fingerprint([F.col("report"), clock.iso(F.col("interval_start")), F.col("zone"),
                       F.col("version").cast("string"), F.col("value_mw").cast("decimal(30,6)").cast("string")])
    return table.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("checksum"))


def hashes(columns: list[str]) -> list[Column]:
    """``_a`` and ``_b``: 128 bits over the columns, nulls counted, as a hash alone passes over them."""
    return [F.xxhash64(*columns).alias("_a"), F.xxhash64(*[F.col(c).isNull() for c in columns], *columns).alias("_b")]


def compare_held(rows: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """table_name, n_rows, differing for each pair of tables, named by their boolean columns in ``rows``; see ``compare``.

    ``rows`` have RAW_KEY, ``_a`` and ``_b``. As ``held`` leaves them they lie by interval, and are counted where they are.
    """
    has = {name: F.col(name).cast("int") for name in {c for pair in pairs.values() for c in pair}}
    counts = rows.groupBy(*RAW_KEY, "_a", "_b").agg(*[c for i, (left, right) in enumerate(pairs.values()) for c in (
        F.sum(has[left] - has[right]).alias(f"_surplus{i}"), F.sum(has[right]).alias(f"_right{i}"))])
    sums = counts.agg(*[c for i in range(len(pairs)) for c in (
        F.coalesce(F.sum(f"_right{i}"), F.lit(0)).cast("bigint").alias(f"n{i}"), F.count_if(F.col(f"_surplus{i}") != 0).alias(f"d{i}"))])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.col(f"n{i}").alias("n_rows"), F.col(f"d{i}").alias("differing"))
                                          for i, name in enumerate(pairs)])))


def compare(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_rows of the right table, and ``differing``, the number of different rows that one table holds more often.

    One signed pass over both. Rows travel as their key and a 128-bit hash of the columns, so long texts stay behind.
    """
    sides = [t.select(*RAW_KEY, *hashes(columns), F.lit(at == 0).alias("_left"), F.lit(at == 1).alias("_right")) for at, t in enumerate((left, right))]
    return compare_held(sides[0].unionByName(sides[1]), {"": ("_left", "_right")}).drop("table_name")


def difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows one table holds more often than the other: the columns, plus ``surplus`` (left count minus right count).

    One grouped pass over both, combined on the map side, in place of two multiset subtractions.
    """
    signed = (left.select(*columns).withColumn("_s", F.lit(1))
              .unionByName(right.select(*columns).withColumn("_s", F.lit(-1))))
    return signed.groupBy(*columns).agg(F.sum("_s").alias("surplus")).where(F.col("surplus") != 0)
