import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.operators import changes, skew

EVENT = ("report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
         "ingested_at timestamp_ntz, source_uri string")
T0 = datetime(2026, 9, 28, 12)


def event(version, value, minute, key=0, uri="f"):
    at = T0 + timedelta(minutes=minute)
    return ("RealtimeTotals", T0 + timedelta(minutes=5 * key), "ONTARIO", version, float(value), at, at, uri)


def walk(events):
    """Reference behaviour of the producer's memory, one event at a time in arrival order."""
    seen, out = {}, []
    for e in events:
        key, version, value = e[:3], e[3], e[4]
        held = seen.get(key)
        if held is not None and held[1] == value:
            continue
        if held is None or version >= held[0]:
            seen[key] = (version, value)
        out.append((*key, version, value, e[6], *seen[key]))
    return sorted(out), seen


def news(spark, rows, **more):
    frame = changes.news_in_arrival_order(spark.createDataFrame(rows, EVENT), **more)
    return sorted((r["report"], r["interval_start"], r["zone"], r["version"], r["value_mw"], r["ingested_at"], r["state_version"],
                   r["state_value"]) for r in frame.collect())


def test_cases_of_the_memory(spark):
    rows = [event(12, 1, 0, key=0), event(12, 1, 1, key=0),               # the same again: nothing
            event(12, 1, 0, key=1), event(13, 1, 1, key=1),               # newer version, same value: nothing
            event(12, 1, 0, key=2), event(13, 2, 1, key=2),               # newer version, new value: sent
            event(12, 1, 0, key=3), event(12, 2, 1, key=3),               # same version, new value: sent
            event(13, 2, 0, key=4), event(11, 1, 1, key=4),               # old version late: sent, state stays
            event(1, 10, 0, key=5), event(5, 10, 1, key=5), event(3, 20, 2, key=5)]  # an equal value does not advance the version
    got = news(spark, rows)
    assert got == walk(rows)[0]
    late = [g for g in got if g[3] == 11][0]
    assert late[6:] == (13, 2.0)
    assert [g for g in got if g[3] == 3][0][6:] == (3, 20.0)


@pytest.mark.parametrize("floor", [None, 0, 30])
def test_hot_intervals_give_the_same_news_as_one_walk(spark, floor):
    rng = random.Random(11 if floor is None else floor)
    rows = []
    for minute in range(1500):
        key = 0 if rng.random() < 0.5 else rng.randint(1, 60)   # one interval holds half of all events
        version = rng.randint(1, 9) if rng.random() < 0.7 else rng.randint(1, 200)
        rows.append(event(version, rng.choice([1, 2, 3]), minute, key, f"f{minute}"))
    assert news(spark, rows, floor=floor) == walk(rows)[0]


@pytest.mark.parametrize("shape", ["rising", "replayed", "falling", "constant"])
def test_slices_of_one_interval_chain_up(spark, shape):
    rng = random.Random(5)
    n = 400
    versions = {"rising": range(n), "replayed": [i % 100 for i in range(n)], "falling": range(n, 0, -1), "constant": [4] * n}[shape]
    rows = [event(v + 1, rng.choice([1, 2]), i, 0, f"f{i}") for i, v in enumerate(versions)]
    assert news(spark, rows, floor=0) == walk(rows)[0]


@pytest.mark.parametrize("floor", [None, 0])
def test_state_carries_over_between_batches(spark, floor):
    rng = random.Random(9)
    rows = [event(rng.randint(1, 9), rng.choice([1, 2, 3]), m, rng.choice([0, 0, 0, 1, 2, 3, 4]), f"f{m}") for m in range(600)]
    first, second = rows[:300], rows[300:]
    one = changes.news_in_arrival_order(spark.createDataFrame(first, EVENT), floor=floor)
    state = changes.moved_state(one)
    got = news(spark, first, floor=floor) + news(spark, second, state=state, floor=floor)
    expected, seen = walk(rows)
    assert sorted(got) == expected
    held = {(r["report"], r["interval_start"], r["zone"]): (r["version"], r["value_mw"]) for r in state.collect()}
    assert held == walk(first)[1]


@pytest.mark.parametrize("floor", [None, 0, 20])
def test_changed_values_in_version_order(spark, floor):
    rng = random.Random(2)
    rows = [event(rng.randint(1, 400), rng.choice([1, 2]), m, 0 if m % 3 else rng.randint(1, 40), f"f{m}") for m in range(1200)]
    rows += rows[:200]  # exact copies
    got = sorted((r["interval_start"], r["version"], r["ingested_at"], r["value_mw"], r["previous_mw"] or 0.0)
                 for r in changes.changed_values(spark.createDataFrame(rows, EVENT), floor).collect())
    expected, last = [], {}
    for e in sorted(rows, key=lambda e: (e[:3], e[3], e[6], e[5], e[7], e[4])):
        if last.get(e[1]) != e[4]:
            expected.append((e[1], e[3], e[6], e[4], last.get(e[1], 0.0)))
        last[e[1]] = e[4]
    assert got == sorted(expected)


def test_silent_restatements(spark):
    rows = [event(1, 5, 0), event(1, 6, 1), event(2, 6, 2), event(2, 6, 3)]
    got = changes.silent_restatements(spark.createDataFrame(rows, EVENT)).collect()
    assert [(r["version"], r["n_values"], r["lowest"], r["highest"]) for r in got] == [(1, 2, 5.0, 6.0)]


def test_hot_keys_are_the_full_ones(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    assert [r["k"] for r in skew.hot_keys(rows, ["k"], floor=100).collect()] == ["hot"]
    assert skew.hot_keys(rows, ["k"]) is None
