"""Demand series, versioned feeds, file listings and metrics read out of the given tables.

Each feed is a projection or one aggregate of a table, so its size and the work on it grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from peakledger.functions import clock, events, names
from peakledger.functions.events import ZONE
from peakledger.operators import merge
from peakledger.operators.durable import stored

REPORTS = ("RealtimeTotals", "PredispTotals", "ICIDemand")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demand_hours(spark: SparkSession, sf_dir: str, by_zone: bool = True) -> DataFrame:
    """Hourly series: zone, interval_start, mw. One zone per return flag, or a single zone."""
    items = table(spark, sf_dir, "lineitem")
    zone = F.col("l_returnflag") if by_zone else F.lit(ZONE)
    he = (F.col("l_partkey") % 9 + 11).cast("int")
    start = clock.hour_ending_to_utc(F.col("l_shipdate").cast("date"), he)
    return (items.groupBy(zone.alias("zone"), start.alias("interval_start"))
            .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("mw")))


def hour_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of ``demand_hours`` as they became known: zone, interval_start, version, known_at, mw.

    Most of an hour is published ten minutes after its end; a sixth and a seventh line of an order are added five hours and three days
    after it, each as a version that restates the hour.
    """
    items = table(spark, sf_dir, "lineitem")
    start = clock.hour_ending_to_utc(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 9 + 11).cast("int"))
    version = F.greatest(F.lit(0), F.col("l_linenumber") - 5).cast("bigint")
    parts = items.groupBy(F.col("l_returnflag").alias("zone"), start.alias("interval_start"), version.alias("version")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("part"))
    so_far = Window.partitionBy("zone", "interval_start").orderBy("version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.when(F.col("version") == 0, clock.minutes(70)).when(F.col("version") == 1, clock.minutes(360)).otherwise(clock.minutes(73 * 60))
    return parts.select("zone", "interval_start", "version", (F.col("interval_start") + later).alias("known_at"),
                        F.sum("part").over(so_far).cast("double").alias("mw"))


def _report(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in REPORTS]), (key % 3 + 1).cast("int"))


def versioned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned demand events with re-sent and restated versions, arriving out of version order."""
    items = table(spark, sf_dir, "lineitem")
    key, report = F.col("l_orderkey"), _report(F.col("l_orderkey"))
    name = F.concat(F.lit("PUB_"), report, F.lit("_"), key.cast("string"), F.lit("_v"), F.col("l_linenumber").cast("string"))
    # 100,000 five-minute intervals per zone keep the time line short however many orders there are.
    start = F.lit("2000-01-01 05:00:00").cast("timestamp_ntz") + clock.minutes((key % 100000 * 5).cast("int"))
    reason = F.when(F.col("l_returnflag") == "A", "live").when(F.col("l_returnflag") == "N", "backfill").otherwise("reconciliation")
    uri = F.concat(F.lit("raw/"), report, F.lit("/"), name, F.lit("#"), F.col("l_partkey").cast("string"), F.lit("-"),
                   F.col("l_suppkey").cast("string"))
    return items.select(
        report.alias("report"), events.measure(report).alias("measure"), start.alias("interval_start"),
        F.concat(F.lit("Z"), F.floor(key / 100000).cast("string")).alias("zone"),
        F.col("l_linenumber").cast("bigint").alias("version"), F.col("l_extendedprice").alias("value_mw"),
        (F.col("l_shipdate") - clock.hours((F.col("l_suppkey") % 72).cast("int"))).alias("published_at"),
        F.col("l_shipdate").alias("ingested_at"), uri.alias("source_uri"),
        F.sha2(name, 256).alias("content_sha256"), reason.alias("reason"))


def is_early(split: str = "1998-01-01") -> Column:
    return F.col("ingested_at") < F.lit(split).cast("timestamp_ntz")


def two_batches(feed: DataFrame, split: str = "1998-01-01") -> tuple[DataFrame, DataFrame]:
    early = is_early(split)
    return feed.where(early), feed.where(~early)


def fine_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings per event type: report, zone, interval_start, version, value_mw."""
    hour = clock.hour_of(F.col("ts"))
    return (table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("report"), hour.alias("interval_start"))
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_mw"),
                 F.count(F.lit(1)).alias("version"))
            .withColumn("zone", F.lit(ZONE)))


def five_minute_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report, interval_start (a multiple of five minutes), value_mw."""
    slot = clock.hour_of(F.col("ts")) + clock.minutes((F.floor(F.minute("ts") / 5) * 5).cast("int"))
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("report"), slot.alias("interval_start")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_mw"))


def hourly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report, interval_start, value_mw as a whole number: what an hourly report says. At every sixth hour it misses some users."""
    counted = (F.hour("ts") % 6 != 0) | (F.col("user_id") % 5 != 0)
    hours = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("report"), clock.hour_of(F.col("ts")).alias("interval_start")).agg(
        F.sum(F.when(counted, F.col("value").cast("decimal(18,2)"))).cast("double").alias("total"),
        F.count_distinct(F.floor(F.minute("ts") / 5)).alias("slots"))
    return hours.select("report", "interval_start", F.rint(F.coalesce("total", F.lit(0.0)) / F.col("slots")).alias("value_mw"))


def kept_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw, current) as a store with faults might hold them, in the columns that checks read; both come out of one stored pass.

    Real-time intervals lie six to one of the feed's, so that most days are full. The current table never saw the seventh
    versions of the reconciliation, holds some rows twice, and some values of the other reports in the wrong unit.
    """
    feed, base = versioned_events(spark, sf_dir), F.lit("2000-01-01 05:00:00").cast("timestamp_ntz")
    slot = F.floor(clock.seconds_between(base, F.col("interval_start")) / 1800).cast("int")
    start = F.when(F.col("report") == "RealtimeTotals", base + clock.minutes(slot * 5)).otherwise(F.col("interval_start"))
    feed = feed.withColumn("interval_start", start)
    seen = ~((F.col("reason") == "reconciliation") & (F.col("version") == 7))
    rows = merge.held(feed, {"_raw": merge.first_held(), "_current": merge.latest_held(seen)})
    kept = stored(rows.select(*events.RAW_KEY, "value_mw", "_raw", "_current"), "kept")
    whole = F.floor("value_mw")
    twice = F.when(whole % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    wrong = (F.col("report") != "ICIDemand") & (whole % 97 == 0)
    current = kept.where("_current").withColumn("_copy", F.explode(twice)).drop("_copy", "_raw", "_current").withColumn(
        "value_mw", F.when(wrong, F.col("value_mw") * 100).otherwise(F.col("value_mw")))
    return kept.where("_raw").drop("_raw", "_current"), current


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with repeats: report, name, published_at, state (line status), flag (return flag).

    Tax-free items are unversioned base files; hour stamps come from the week of the ship date.
    """
    items = table(spark, sf_dir, "lineitem")
    report = _report(F.col("l_orderkey"))
    ext = names.lookup(names.EXTENSION, report)
    version = (F.col("l_linenumber") + 7 * (F.col("l_suppkey") % 2)).cast("string")
    hour = F.col("l_shipdate") + clock.hours((F.col("l_partkey") % 24).cast("int"))
    # Four groups a week, so that groups fill up.
    monday = F.date_sub(F.col("l_shipdate").cast("date"), F.weekday("l_shipdate"))
    stamp = clock.hour_stamp(monday.cast("timestamp_ntz") + clock.hours((F.col("l_partkey") % 4 * 6).cast("int")))
    suffix = F.when(F.col("l_tax") == 0, "").otherwise(F.concat(F.lit("_v"), version))
    return items.select(
        report.alias("report"), F.concat(F.lit("PUB_"), report, F.lit("_"), stamp, suffix, F.lit("."), ext).alias("name"),
        (hour + clock.minutes((F.col("l_orderkey") % 60).cast("int"))).alias("published_at"),
        F.col("l_linestatus").alias("state"), F.col("l_returnflag").alias("flag"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples: ts, service, partition, name, value. Services are event types; six partitions."""
    return table(spark, sf_dir, "events").select(
        "ts", F.col("event_type").alias("service"), (F.col("user_id") % 6).alias("partition"),
        F.col("value").alias("value"), F.col("event_id").alias("sample_id"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, value: one contract message per event, whole for ids divisible by 11 and damaged in a fixed way for the others."""
    rows = table(spark, sf_dir, "events")
    second, hour = clock.iso(F.col("ts")), clock.iso(clock.hour_of(F.col("ts")))
    text = F.concat(
        F.lit('{"schema_version":1,"report":"'), _report(F.col("event_id")), F.lit('","measure":"ontario_demand","interval_start":"'),
        hour, F.lit('","zone":"ONTARIO","version":'), (F.col("user_id") + 1).cast("string"), F.lit(',"value_mw":'),
        F.col("value").cast("string"), F.lit(',"published_at":"'), second, F.lit('","ingested_at":"'), second,
        F.lit('","source_uri":"raw/'), F.col("event_type"), F.lit('","content_sha256":"'), F.sha2("props", 256),
        F.lit('","reason":"live"}'))
    t, damage = F.col("text"), F.col("event_id") % 11
    value = (F.when(damage == 1, F.regexp_replace(t, '"value_mw":([^,]*),', '"value_mw":"$1",'))
             .when(damage == 2, F.replace(t, F.lit(',"reason":"live"'), F.lit("")))
             .when(damage == 3, F.replace(t, F.lit('"reason"'), F.lit('"note":1,"reason"')))
             .when(damage == 4, F.expr("left(text, length(text) - 1)"))
             .when(damage == 5, F.replace(t, F.lit("T"), F.lit(" ")))
             .when(damage == 6, F.regexp_replace(t, r'"version":\d+', '"version":0'))
             .when(damage == 7, F.lit("[1]"))
             .when(damage == 8, F.regexp_replace(t, r'"version":\d+', '"version":1.5'))
             .when(damage == 9, F.replace(t, F.lit('"ONTARIO"'), F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))))
             .when(damage == 10, F.regexp_replace(t, r'"interval_start":"\d{4}-\d{2}', '"interval_start":"2024-13'))
             .otherwise(t))
    return rows.withColumn("text", text).select("event_id", value.alias("value"))


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic, partition, high, low, position, committed; -1001 stands for an unknown offset."""
    part = F.col("user_id") % 6
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("topic"), part.alias("partition")).agg(
        F.count(F.lit(1)).alias("high"), F.count_if(F.col("value") < 60).alias("p"), F.count_if(F.col("value") < 40).alias("c"))
    third = F.col("partition") % 3
    return counts.select("topic", "partition", "high", F.lit(0).alias("low"),
                         F.when(third == 0, F.col("p")).otherwise(F.lit(-1001)).alias("position"),
                         F.when(third < 2, F.col("c")).otherwise(F.lit(-1001)).alias("committed"))


def load_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-test samples: run (service and day), elapsed_s, replicas, lag."""
    second = clock.seconds_between(clock.midnight_of(F.col("ts")), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", "event_type", F.col("ts").cast("date").cast("string")).alias("run"), F.floor(second).cast("bigint").alias("elapsed_s"),
        (F.col("user_id") % 7).alias("replicas"), F.greatest(F.lit(0), F.floor("value") - 30).alias("lag"))
