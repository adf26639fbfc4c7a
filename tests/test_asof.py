"""Values as known at an instant, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.functions import clock
from peakledger.operators import asof, rule, series

HOUR = timedelta(hours=1)
VERSIONS = "zone string, interval_start timestamp_ntz, version bigint, known_at timestamp_ntz, mw double"
MONTHS, MARGINS = [5, 6], {"persist2": 0.97, "persist4": 0.95, "day_ahead": 0.96}


def restated(seed, days=16):
    """Hours of two zones, published after their end and often restated hours or days later, up or down."""
    pick, rows = random.Random(seed), []
    for zone in ("A", "B"):
        for n in range(days * 24):
            start = datetime(2026, 5, 1, 5) + n * HOUR
            if pick.random() < 0.05:
                continue
            known, mw = start + HOUR + timedelta(minutes=pick.choice([5, 10, 40])), float(pick.randrange(10_000, 26_000))
            for version in range(pick.choice([1, 1, 2, 3])):
                rows.append((zone, start, version, known, mw))
                known, mw = known + timedelta(hours=pick.choice([1, 3, 30])), mw + pick.choice([-4000.0, 500.0, 6000.0])
    return rows


def brute(rows):
    """{(zone, variant, hour): (estimate, bar, risk)} by reading every version that was known, for each decision."""
    out = {}
    hours = sorted({(z, s) for z, s, *_ in rows})

    def seen(zone, when):
        now = {}
        for z, s, version, known, mw in rows:
            if z == zone and known <= when:
                now.setdefault(s, []).append((known, version, mw))
        return {s: max(v)[2] for s, v in now.items()}

    ages = {"persist2": 2, "persist4": 4}
    for zone, start in hours:
        local = start - 5 * HOUR
        if local.month not in MONTHS or not 12 <= local.hour + 1 <= 18:
            continue
        for variant, margin in MARGINS.items():
            midnight = datetime(local.year, local.month, local.day) + 5 * HOUR
            when = midnight + timedelta(minutes=15) if variant == "day_ahead" else start - (ages[variant] - 1) * HOUR + timedelta(minutes=15)
            now, peaks = seen(zone, when), {}
            for s, mw in now.items():
                day = (s - 5 * HOUR).date()
                peaks[day] = max(mw, peaks.get(day, mw))
            eff = (when - timedelta(minutes=15) - 5 * HOUR).date()
            estimate = peaks.get(local.date() - timedelta(days=1)) if variant == "day_ahead" else now.get(start - ages[variant] * HOUR)
            before = sorted((p for d, p in peaks.items() if d < eff), reverse=True)
            bar = before[4] if len(before) > 4 else None
            out[zone, variant, start] = (estimate, bar, estimate is not None and bar is not None and estimate >= margin * bar)
    return out


def decided(spark, rows):
    versions = spark.createDataFrame(rows, VERSIONS)
    hours = versions.select("zone", "interval_start").distinct()
    asked = rule.with_params(rule.every_hour(hours, clock.LIVE_VARIANTS), MARGINS, MONTHS, 12, 18)
    out = asof.decide_as_known(asked, versions).collect()
    found = {(r["zone"], r["variant"], r["candidate_hour"]): (r["estimate"], r["bar"], r["risk"]) for r in out}
    assert len(found) == len(out)
    return found


def test_decisions_by_brute_force(spark):
    rows = restated(1)
    want = brute(rows)
    assert decided(spark, rows) == want and {True, False} == {w[2] for w in want.values()}
    final = {}
    for z, s, version, known, mw in rows:
        final[z, s] = max(final.get((z, s), (known, version, mw)), (known, version, mw))
    assert any(w[0] not in (None, final.get((z, s - 2 * HOUR), (0, 0, None))[2]) for (z, v, s), w in want.items() if v == "persist2")


def test_no_look_ahead(spark):
    """What becomes known after a decision, or is rewritten after it, changes nothing."""
    rows, pick = restated(2), random.Random(5)
    when = datetime(2026, 5, 12, 20)
    later = [r if r[3] <= when else (*r[:4], float(pick.randrange(1, 90_000))) for r in rows]
    one, other = decided(spark, rows), decided(spark, later)
    before = [k for k in one if (k[2] - 5 * HOUR).date() < when.date()]
    assert before and {k: one[k] for k in before} == {k: other[k] for k in before} and one != other


def test_versions_known_at_once_is_the_rule_on_final_values(spark):
    rows = [(z, s, 0, s + HOUR + timedelta(minutes=5), mw) for (z, s), mw in {(r[0], r[1]): r[4] for r in restated(3)}.items()]
    points = spark.createDataFrame([(z, s, mw) for z, s, _, _, mw in rows], "zone string, interval_start timestamp_ntz, mw double")
    asked = rule.with_params(rule.every_hour(points, clock.LIVE_VARIANTS), MARGINS, MONTHS, 12, 18)
    final = rule.decide(asked, points, series.daily_peaks(points)).where("in_window").collect()
    known = decided(spark, rows)
    assert {k: v[2] for k, v in known.items()} == {(r["zone"], r["variant"], r["candidate_hour"]): r["risk"] for r in final}


@pytest.mark.parametrize("rows, want", [([], [None, None, None]), ([(1, 5, 10.0), (1, 5, 11.0), (2, 7, 20.0)], [None, 10.0, 20.0])])
def test_as_known_takes_ties_nulls_and_empty_tables(spark, rows, want):
    versions = spark.createDataFrame([(None, v, t, x) for v, t, x in rows] + [("other", 0, 0, 1.0)], "k string, version int, known_at int, x double")
    asked = spark.createDataFrame([(None, 4, "a"), (None, 5, "b"), (None, 9, "c")], "k string, asked_at int, version string")
    got = asof.as_known(asked, versions, ["k"], "x").orderBy("asked_at").collect()
    assert [r["version"] for r in got] == ["a", "b", "c"] and [r["x"] for r in got][::2] == want[::2]
    assert got[1]["x"] in ({10.0, 11.0} if rows else {None})
    assert asof.as_known(asked.limit(0), versions, ["k"], "x").count() == 0


def test_equal_versions_count_in_their_order(spark):
    versions = spark.createDataFrame([("a", 2, 5, 2.0), ("a", 1, 5, 1.0)], "k string, version int, known_at int, x double")
    assert asof.as_known(spark.createDataFrame([("a", 5)], "k string, asked_at int"), versions, ["k"], "x").first()["x"] == 2.0
    assert asof.peak_versions(spark.createDataFrame([], VERSIONS)).where(F.lit(True)).count() == 0
