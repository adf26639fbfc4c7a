"""Figures rolled up from stored minutes against the samples themselves."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from peakledger.operators import sketches
from peakledger.streaming import monitors
from tests.test_monitors import streamed

SAMPLE = "service string, partition bigint, ts timestamp_ntz, value double"
BEGIN = datetime(2026, 3, 28, 22, 30)


def data(n=6000):
    pick = random.Random(5)
    rows = [("busy" if pick.random() < 0.9 else "calm", 0, BEGIN + timedelta(seconds=pick.randrange(4 * 3600)), pick.expovariate(0.01)) for _ in range(n)]
    return rows + [("busy", 0, BEGIN, 7.0)] * 500  # ties


def by_day(rows):
    out = {}
    for service, _, ts, value in rows:
        out.setdefault((service, ts.replace(hour=0, minute=0, second=0)), []).append(value)
    return out


def test_days_from_minutes(spark):
    rows = data()
    minutes = sketches.per_minute(spark.createDataFrame(rows, SAMPLE))
    got = {(r["service"], r["period"]): r for r in sketches.figures(sketches.days(sketches.hours(minutes)), 86_400).collect()}
    want = by_day(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        r = got[key]
        assert (r["samples"], r["highest"]) == (len(values), max(values)) and abs(r["total"] - sum(values)) < 0.01
        for rank, value in ((0.5, r["p50"]), (0.95, r["p95"])):
            below, up_to = sum(v < value for v in values) / len(values), sum(v <= value for v in values) / len(values)
            assert below - 0.01 <= rank <= up_to + 0.01


def test_nulls_few_samples_and_none(spark):
    rows = [("a", 0, BEGIN, None), ("b", 0, BEGIN, 3.0), ("b", 0, BEGIN, None), (None, 0, BEGIN, 1.0)]
    out = sketches.figures(sketches.hours(sketches.per_minute(spark.createDataFrame(rows, SAMPLE))), 3600)
    got = {r["service"]: (r["samples"], r["highest"], r["p50"], r["p95"]) for r in out.collect()}
    assert got == {"a": (1, None, None, None), "b": (2, 3.0, 3.0, 3.0), None: (1, 1.0, 1.0, 1.0)}
    assert sketches.figures(sketches.days(sketches.per_minute(spark.createDataFrame([], SAMPLE))), 86_400).count() == 0


def test_a_minute_kept_in_several_rows_counts_once(spark):
    rows = data(1000)
    parts = [sketches.per_minute(spark.createDataFrame(rows[k::3], SAMPLE)) for k in range(3)]
    whole = sketches.hours(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert whole.agg(F.sum("samples")).first()[0] == len(rows)
    assert whole.select(F.sum(F.kll_sketch_get_n_double("sketch"))).first()[0] == len(rows)


def test_minutes_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    rows = sorted(data(600), key=lambda r: r[2])
    streamed(spark, str(tmp_path), rows, monitors.minute_sketches)
    stored = spark.read.schema(sketches.ROW).parquet(f"{tmp_path}/out").where("service <> 'end'")
    def figures(minutes):
        return {tuple(r) for r in sketches.hours(minutes).select("service", "period", "samples", "highest", "total").collect()}
    assert figures(stored) == figures(sketches.per_minute(spark.createDataFrame(rows, SAMPLE)))
