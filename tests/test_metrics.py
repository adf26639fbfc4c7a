import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.operators import content, completeness, metrics, selection
from peakledger.sources import files

T = datetime(2026, 10, 6, 12)
SAMPLE = "service string, partition bigint, ts timestamp_ntz, value double"


def test_exact_positions(spark):
    rng = random.Random(3)
    values = {g: [int(rng.expovariate(1 / 9000)) - 500 for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 999), ("d", 5000))}
    values["d"] += [7] * 4000  # many copies of one value
    frame = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v bigint")
    n = F.col("n")
    got = {r["g"]: r for r in selection.nth_values(frame, ["g"], "v", {"mid": F.floor(n / 2), "high": F.floor(n * F.lit(0.95)), "top": n - 1}).collect()}
    for g, vs in values.items():
        s = sorted(vs)
        assert (got[g]["n"], got[g]["mid"], got[g]["high"], got[g]["top"]) == (len(s), s[len(s) // 2], s[int(len(s) * 0.95)], s[-1])
    whole = selection.nth_values(frame, [], "v", {"mid": F.floor(n / 2)}).first()
    every = sorted(v for vs in values.values() for v in vs)
    assert whole["mid"] == every[len(every) // 2]
    medians = {r["g"]: r["median"] for r in selection.median(frame, ["g"], "v").collect()}
    import statistics
    assert medians == {g: statistics.median(vs) for g, vs in values.items()}


def test_lag_per_partition(spark):
    rows = [("t", 0, 83, 0, 51, 60), ("t", 1, 64, 0, -1001, 47), ("t", 2, 19, 6, -1001, -1001), ("u", 0, 2975, 0, -1001, 2975), ("u", 1, 5, 0, 9, 9)]
    frame = spark.createDataFrame(rows, "topic string, partition bigint, high bigint, low bigint, position bigint, committed bigint")
    got = {(r["topic"], r["partition"]): r["lag"] for r in metrics.partition_lag(frame).collect()}
    assert got == {("t", "0"): 32, ("t", "1"): 17, ("t", "2"): 13, ("u", "0"): 0, ("u", "1"): 0, ("t", "all"): 62, ("u", "all"): 0, ("all", "all"): 62}


# run -> samples (elapsed, replicas, lag) and: peak lag, drained after, events a second, most replicas, second replica at, alone again at
RUNS = {
    "alone": ([(0, 1, 900), (5, 1, 640), (12, 1, 210), (36, 1, 0), (41, 1, 0)], (900, 36, 25.0, 1, None, None)),
    "grown": ([(0, 1, 7000), (8, 2, 7700), (16, 4, 5100), (70, 4, 0), (90, 2, 0), (110, 1, 0), (130, 1, 0)], (7700, 70, 110.0, 4, 8, 110)),
    "stuck": ([(0, 1, 400), (9, 3, 420), (18, 3, 410)], (420, None, None, 3, 9, None)),
}


def test_drain_summary(spark):
    rows = [(k, *s) for k, (samples, _) in RUNS.items() for s in samples]
    frame = spark.createDataFrame(rows, "run string, elapsed_s bigint, replicas bigint, lag bigint")
    got = {r["run"]: tuple(r)[1:] for r in metrics.drain_summary(frame).collect()}
    assert got == {k: expected for k, (_, expected) in RUNS.items()}


def test_load_samples_are_read_with_their_run(spark, tmp_path):
    (tmp_path / "scaled-1.csv").write_text("elapsed_s,replicas,lag\n0,1,815\n7,3,222\n31,3,0\n")
    got = files.load_samples(spark, str(tmp_path)).orderBy("elapsed_s").collect()
    assert [tuple(r) for r in got] == [("scaled-1", 0, 1, 815), ("scaled-1", 7, 3, 222), ("scaled-1", 31, 3, 0)]


def test_alerts(spark):
    at = lambda m, v, p=0, s=0: ("c", p, T + timedelta(minutes=m, seconds=s), float(v))
    ages = spark.createDataFrame([at(0, 60), at(1, 5401), at(2, 30)], SAMPLE)
    ticks = sorted(r["tick"] for r in metrics.stale_alerts(ages).collect())
    assert ticks == [T + timedelta(minutes=m) for m in range(1, 11)]  # for as long as the high value is in view
    lags = spark.createDataFrame([at(m, 1500, p) for m in range(8) for p in (0, 1)] + [at(8, 10, 0), at(0, 0, 0, -30)], SAMPLE)
    fired = {r["tick"]: r["observed"] for r in metrics.lag_alerts(lags).collect()}
    assert T + timedelta(minutes=4) in fired and fired[T + timedelta(minutes=5)] == 3000
    assert T + timedelta(minutes=8) not in fired
    failures = spark.createDataFrame([at(m, 1) for m in (0, 1, 2, 14)], SAMPLE)
    assert [(r["tick"], r["observed"]) for r in metrics.failure_alerts(failures).collect()] == [(T + timedelta(minutes=14), 4.0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_silences_equal_a_plain_scan(spark, seed):
    rng = random.Random(seed)
    rows, at = [], T
    for _ in range(400):
        at += timedelta(seconds=rng.choice([1, 30, 300, 1199, 1200, 1201, 4000]))
        rows.append(("c", 0, at, 1.0))
    got = sorted((r["silent_from"], r["silent_until"]) for r in metrics.silences(spark.createDataFrame(rows, SAMPLE)).collect())
    assert got == [(a[2], b[2]) for a, b in zip(rows, rows[1:]) if b[2] - a[2] > timedelta(minutes=20)]


def test_a_silence_that_goes_on_is_reported(spark):
    rows = spark.createDataFrame([("a", 0, T, 1.0), ("b", 0, T + timedelta(minutes=50), 1.0)], SAMPLE)
    got = metrics.silences(rows, as_of=F.lit(str(T + timedelta(minutes=60))).cast("timestamp_ntz")).collect()
    assert [(r["service"], r["seconds"], r["still_silent"]) for r in got] == [("a", 3600.0, True)]
    assert metrics.silences(rows).isEmpty()


def test_hourly_values_are_held_against_the_mean(spark):
    kind = "report string, interval_start timestamp_ntz, value_mw double"
    fine = [("R", T + timedelta(minutes=5 * i), 100.0 + i) for i in range(24)]         # means 105.5 and 117.5, both to the even number
    hourly = [("R", T, 106.0), ("R", T + timedelta(hours=1), 117.0), ("R", T + timedelta(hours=2), 1.0)]
    r = completeness.hourly_against_fine(spark.createDataFrame(hourly, kind), spark.createDataFrame(fine, kind)).first()
    assert (r["hours"], r["apart"], r["most_slots"], r["highest_mean"]) == (2, 1, 12, 118.0)


def test_percentile_of_fractions(spark):
    rows = spark.createDataFrame([("s", 0, T + timedelta(seconds=i), 1 + i / 1000) for i in range(100)], SAMPLE)
    assert metrics.health_rollup(rows).first()["p95"] == 1.095


def test_latency_counts_live_events_only(spark):
    rows = [("R", "live", T, T + timedelta(seconds=s)) for s in (10, 20, 30, 40)] + [("R", "backfill", T, T + timedelta(days=9))]
    frame = spark.createDataFrame(rows, "report string, reason string, published_at timestamp_ntz, ingested_at timestamp_ntz")
    r = metrics.latency_percentiles(frame).first()
    assert (r["n"], r["latency_p50_s"], r["latency_p95_s"], r["latency_max_s"]) == (4, 30, 40, 40)
    age = metrics.data_age(frame, F.lit(T + timedelta(minutes=95)).cast("timestamp_ntz")).first()
    assert age["data_age_s"] == 95 * 60


def test_positions_and_content(spark):
    rows = [("a", i) for i in range(1, 25)] + [("b", i) for i in (1, 2, 4)] + [("c", 1), ("c", 1)] + [("d", 1), ("d", 2)]
    got = {r["f"]: (r["prefix"], r["complete"]) for r in completeness.positions(spark.createDataFrame(rows, "f string, p int"), ["f"], "p", 24).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (False, False), "d": (True, False)}
    points = [("x", T + timedelta(hours=i), float(i)) for i in range(50)]
    schema = "file string, interval_start timestamp_ntz, value_mw double"
    base = content.content_hash(spark.createDataFrame(points, schema), ["file"]).first()["content_hash"]
    assert content.content_hash(spark.createDataFrame(points[::-1], schema), ["file"]).first()["content_hash"] == base
    points[3] = ("x", T, 3.5)
    assert content.content_hash(spark.createDataFrame(points, schema), ["file"]).first()["content_hash"] != base
