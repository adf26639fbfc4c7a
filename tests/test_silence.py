"""No-data alarms by timers: against the batch form, and while nothing arrives at all."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.operators import metrics
from peakledger.streaming import silence, stateful

SAMPLES = "service string, ts timestamp_ntz"
BEGIN = datetime(2026, 3, 29, 0, 40)


@pytest.fixture(autouse=True)
def typed_state(spark):
    before = spark.conf.get(stateful.STORE[0])
    spark.conf.set(*stateful.STORE)
    yield
    spark.conf.set(stateful.STORE[0], before)


def rows(seed):
    pick, out = random.Random(seed), []
    for service in ("a", "b", None):
        at = BEGIN
        for _ in range(60):
            at += timedelta(seconds=pick.choice([0, 1, 45, 300, 1199, 1200, 1201, 4000]), microseconds=pick.choice([0, 0, 1]))
            out.append((service, at))
    return sorted(out, key=lambda r: r[1])


def land(spark, folder, part):
    spark.createDataFrame(part, SAMPLES).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def alarms(spark, folder, **options):
    source = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = (silence.silence_alarms(source, **options).writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/cp"))
    return query


def read(spark, folder):
    return spark.read.schema("service string, kind string, silent_from timestamp_ntz, at timestamp_ntz").parquet(f"{folder}/out")


def finish(query):
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_alarms_of_a_stream_are_the_silences_of_the_batch(spark, tmp_path):
    given, folder, pick = rows(3), str(tmp_path), random.Random(5)
    end = given[-1][1] + timedelta(days=30)
    for k in range(0, len(given), 45):  # shuffled inside a file
        part = [*given[k:k + 45], ("a", None)]
        pick.shuffle(part)
        land(spark, folder, part)
    land(spark, folder, [("end", end)])
    finish(alarms(spark, folder, late="20 days"))
    land(spark, folder, [("end", end + timedelta(minutes=1))])  # a restart goes on with state and timers
    finish(alarms(spark, folder, late="20 days"))
    got = read(spark, folder).where(F.col("service").isNull() | (F.col("service") != "end"))
    closed = metrics.silences(spark.createDataFrame(given, SAMPLES), as_of=F.lit(str(end)).cast("timestamp_ntz")).collect()
    key = lambda r: (r[0] or "", *r[1:])
    want = [(r["service"], "alarm", r["silent_from"], r["silent_from"] + timedelta(minutes=20)) for r in closed]
    want += [(r["service"], "recovery", r["silent_from"], r["silent_until"]) for r in closed if not r["still_silent"]]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(r["still_silent"] for r in closed) == 3 and len(closed) > 20


def test_a_silent_service_raises_one_alarm_and_one_recovery_while_nothing_arrives(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, [("a", BEGIN), ("b", None)])
    query = alarms(spark, folder, limit_minutes=0.05, arrival=True).trigger(processingTime="500 milliseconds").start()
    def until(done, seconds=60):
        stop = time.monotonic() + seconds
        while not done() and time.monotonic() < stop:
            assert query.exception() is None
            time.sleep(0.5)
        assert done()
    try:
        until(lambda: read(spark, folder).where("kind = 'alarm'").count() >= 2)
        time.sleep(4)  # longer than the limit: an alarm is not repeated
        land(spark, folder, [("a", BEGIN)])
        until(lambda: read(spark, folder).where("kind = 'recovery'").count() >= 1)
    finally:
        query.stop()
    first = read(spark, folder).groupBy("service", "kind").count().collect()
    seen = {(r["service"], r["kind"]): r["count"] for r in first}
    assert seen[("b", "alarm")] == 1 and seen[("a", "recovery")] == 1 and ("b", "recovery") not in seen
    back = read(spark, folder).where("kind = 'recovery'").first()
    assert back["at"] - back["silent_from"] > timedelta(seconds=3)
