"""Differences by day sums against counting every row."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from peakledger.operators import difference
from peakledger.operators.durable import stored

ROW = "report string, zone string, interval_start timestamp_ntz, version bigint, value_mw double"
COLUMNS = ["report", "zone", "interval_start", "version", "value_mw"]


def rows(seed, n=400):
    pick, begin = random.Random(seed), datetime(2026, 1, 1)
    return [(pick.choice("RP"), pick.choice("AB"), begin + timedelta(hours=pick.randrange(24 * 30)), pick.randrange(4),
             pick.choice([1.0, 2.5, 1e-9])) for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, ROW).withColumn("day", F.col("interval_start").cast("date"))


def found(spark, left, right):
    return {tuple(r)[:5]: r["surplus"] for r in difference.differing_rows(frame(spark, left), frame(spark, right), COLUMNS).collect()}


def expected(left, right):
    counts = Counter(left)
    counts.subtract(Counter(right))
    return {k: v for k, v in counts.items() if v}


def test_changed_lost_added_and_repeated_rows(spark):
    left = rows(1)
    right = left[5:] + [left[9], left[9]] + rows(2, 3)  # lost, copied, added
    at = 50
    right[at] = (*right[at][:4], right[at][4] + 1e-12)  # far below a millionth
    random.Random(3).shuffle(right)
    assert found(spark, left, right) == expected(left, right)


def test_nulls_anywhere_and_empty_tables(spark):
    whole = rows(4, 30)
    holes = [(None, "A", whole[0][2], 1, 1.0), ("R", None, whole[1][2], 1, None), ("R", "A", None, None, 2.5), ("R", "A", whole[3][2], None, 1.0)]
    assert found(spark, whole + holes, whole + holes[:1] + holes[:1]) == expected(whole + holes, whole + holes[:1] + holes[:1])
    assert found(spark, whole + holes, whole + holes) == {}
    assert found(spark, whole, []) == expected(whole, []) and found(spark, [], []) == {}


def test_two_nulls_that_trade_places_are_seen(spark):
    one, other = ("R", "A", datetime(2026, 1, 1), None, 1.0), ("R", "A", datetime(2026, 1, 1), 1, None)
    assert found(spark, [one], [other]) == {one: 1, other: -1}


def test_levels_narrow_the_search(spark):
    left = rows(5)
    right = [r for r in left if not (r[0] == "R" and r[1] == "A" and r[2] < datetime(2026, 1, 3))]
    gone = set(left) - set(right)
    buckets = difference.compared(*[difference.day_sums(frame(spark, t), COLUMNS) for t in (left, right)])
    got = {r["level"]: (r["buckets"], r["unequal"]) for r in difference.levels(buckets).collect()}
    day = lambda r: (r[0], r[1], r[2].date())
    assert got == {"report": (2, 1), "zone": (4, 1), "day": (len(set(map(day, left))), len(set(map(day, gone))))}


def test_only_unequal_days_of_a_stored_table_are_opened(spark):
    left = rows(6)
    right = [r for r in left if r[2].date() != left[0][2].date()]
    tables = [stored(frame(spark, t), "difference-test", "day") for t in (left, right)]
    out = difference.differing_rows(*tables, COLUMNS)
    assert "dynamicpruning" in out._jdf.queryExecution().toString()
    assert {tuple(r)[:5]: r["surplus"] for r in out.collect()} == expected(left, right)
