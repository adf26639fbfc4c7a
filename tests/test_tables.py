from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.functions.events import TABLE_SCHEMA
from peakledger.operators import merge, quality, reconcile
from peakledger.streaming import warehouse
from peakledger.streaming.warehouse import CURRENT, RAW, Warehouse

T = datetime(2026, 9, 28, 12)


def row(report="RealtimeTotals", start=T, version=1, value=16000.0, ingested=datetime(2026, 9, 28, 12, 56), zone="ONTARIO"):
    return (report, "ontario_demand", start, zone, version, float(value), ingested, ingested, ingested, f"raw/{version}", "a" * 64, "live")


def frame(spark, rows):
    return spark.createDataFrame(rows, TABLE_SCHEMA)


def after(spark, *batches):
    """(raw, current) after the batches, with the pure functions."""
    raw = current = frame(spark, [])
    for batch in batches:
        raw, current = merge.merge_raw(raw, frame(spark, batch)), merge.merge_current(current, frame(spark, batch))
    pick = lambda df: sorted((r["interval_start"], r["version"], r["value_mw"]) for r in df.collect())
    return pick(raw), pick(current)


LATER = datetime(2026, 9, 28, 13, 10)
CASES = {
    "first write": ([[row(), row(start=T + timedelta(minutes=5))]], 2, [(T, 1, 16000.0), (T + timedelta(minutes=5), 1, 16000.0)]),
    "same batch again": ([[row()], [row()]], 1, [(T, 1, 16000.0)]),
    "copies in a batch": ([[row(), row(), row()]], 1, [(T, 1, 16000.0)]),
    "newer version": ([[row()], [row(version=2, value=16100)]], 2, [(T, 2, 16100.0)]),
    "older version late": ([[row(version=2, value=16100)], [row()]], 2, [(T, 2, 16100.0)]),
    "same version later": ([[row(version=2)], [row(version=2, value=16050, ingested=LATER)]], 1, [(T, 2, 16050.0)]),
    "versions in one batch": ([[row(), row(version=3, value=16300), row(version=2, value=16200)]], 3, [(T, 3, 16300.0)]),
}


@pytest.mark.parametrize("name", CASES)
def test_merges(spark, tmp_path, name):
    batches, raw_rows, expected = CASES[name]
    raw, current = after(spark, *batches)
    assert len(raw) == raw_rows and current == expected
    house = Warehouse(spark, str(tmp_path / "w"))
    for batch in batches:
        house.write_batch(frame(spark, batch))
    pick = lambda df: sorted((r["interval_start"], r["version"], r["value_mw"]) for r in df.collect())
    assert (pick(house.raw()), pick(house.current())) == (raw, current)


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    assert house.raw().count() == house.signals().count() == 0
    assert house.write_batch(frame(spark, [row()])) and house.write_batch(frame(spark, [row()]))
    assert house.rows(RAW).count() == house.rows(CURRENT).count() == 1
    with pytest.raises(ValueError, match="without"):
        house.write_batch(frame(spark, [row()]).withColumn("interval_start", F.lit(None).cast("timestamp_ntz")))
    assert not house.write_batch(frame(spark, []))
    # a write that ended between the tables, and one that two tries left twice
    house.append({RAW: frame(spark, [row(version=3), row(version=2)])})
    house.append({RAW: frame(spark, [row(version=3)])})
    house.write_batch(frame(spark, [row(version=3), row(version=2)]))
    assert sorted(r["version"] for r in house.raw().collect()) == [1, 2, 3]
    assert [r["version"] for r in house.current().collect()] == [3]


def test_a_batch_opens_its_own_days_only(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    batches = [frame(spark, [row(start=T + timedelta(days=d), value=d)]) for d in range(4)]
    for batch in batches:
        house.write_batch(batch)
    days = warehouse.days_of(batches[2].unionByName(batches[2]), "interval_start")
    kept = house.rows(RAW, days=days)
    assert "dynamicpruning" in kept._jdf.queryExecution().toString()
    assert [r["value_mw"] for r in kept.collect()] == [2.0]
    assert house.write_batch(batches[0].limit(0)) is False and house.raw().count() == 4


def test_delete_and_truncate(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    days = [T + timedelta(days=d) for d in range(3)]
    house.write_batch(frame(spark, [row(start=d) for d in days]))
    house.write_batch(frame(spark, [row(start=d, version=2, value=1) for d in days]))
    house.delete_intervals("ICIDemand", spark.createDataFrame([(days[0],)], "interval_start timestamp_ntz"))
    house.delete_intervals("RealtimeTotals", spark.createDataFrame([(days[1],)], "interval_start timestamp_ntz"))
    assert {r["interval_start"] for r in house.raw().collect()} == {days[0], days[2]} == {r["interval_start"] for r in house.current().collect()}
    house.write_batch(frame(spark, [row(start=days[1], version=1)]))
    assert {(r["interval_start"], r["version"]) for r in house.current().collect()} == {(days[0], 2), (days[1], 1), (days[2], 2)}
    plan = house.raw(date(2026, 9, 28), date(2026, 9, 28))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    house.truncate()
    assert house.raw().count() == house.current().count() == 0
    house.write_batch(frame(spark, [row()]))
    assert house.raw().count() == 1


DAY = datetime(2026, 9, 20, 5)  # midnight, market time


def clean(spark):
    rows = [row(report="ICIDemand", value=15000, start=DAY)]
    rows += [row(start=DAY + timedelta(minutes=5 * i), value=15000 + i % 50) for i in range(288 * 3)]
    return frame(spark, rows)


def test_quality_is_green_on_clean_data_and_red_on_damage(spark):
    good = clean(spark)
    report = lambda current: {r["check"]: r["violations"] for r in quality.report(good, current).collect()}
    assert report(good) == {"duplicate_keys": 0, "current_matches_raw": 0, "values_in_range": 0, "realtime_gaps": 0}
    noon = (F.col("interval_start") == F.lit("2026-09-21 12:00:00").cast("timestamp_ntz")) & (F.col("report") == "RealtimeTotals")
    assert report(good.unionByName(good.where(noon)))["duplicate_keys"] == 1
    assert report(good.withColumn("version", F.when(noon, 0).otherwise(F.col("version")).cast("bigint")))["current_matches_raw"] == 1
    assert report(good.withColumn("value_mw", F.when(noon, 999999.0).otherwise(F.col("value_mw"))))["values_in_range"] == 1
    assert report(good.where(~noon))["realtime_gaps"] == 1
    assert report(good.where(F.col("report") != "ICIDemand"))["values_in_range"] == 288 * 3  # no history: every row counts


def test_checksum_ignores_order_and_sees_any_change(spark):
    good = clean(spark)
    base = merge.checksum(good).first()
    assert merge.checksum(good.orderBy(F.desc("interval_start")).repartition(5)).first() == base
    assert merge.checksum(good.withColumn("value_mw", F.when(F.col("report") == "ICIDemand", 1.0).otherwise(F.col("value_mw")))).first() != base
    assert merge.difference(good, good.repartition(3), ["report", "interval_start", "value_mw"]).isEmpty()
    assert merge.difference(good.unionByName(good.limit(1)), good, ["report", "interval_start", "value_mw"]).count() == 1


def test_compare_counts_what_differs(spark):
    good, columns = clean(spark), ["report", "interval_start", "zone", "version", "value_mw"]
    n = good.count()
    assert tuple(merge.compare(good, good.repartition(3), columns).first()) == (n, 0)
    assert tuple(merge.compare(good, good.where("report <> 'ICIDemand'"), columns).first())[1] == good.where("report = 'ICIDemand'").count()
    changed = good.withColumn("value_mw", F.when(F.col("report") == "ICIDemand", F.lit(None)).otherwise(F.col("value_mw")))
    assert tuple(merge.compare(good, changed, columns).first()) == (n, 2 * good.where("report = 'ICIDemand'").count())
    assert tuple(merge.compare(good, good.limit(0), columns).first()) == (0, n)


def test_landed_counts_versions_at_least_as_new(spark):
    current = frame(spark, [row(version=1), row(start=T + timedelta(minutes=5), version=3)])
    ask = lambda *rows: reconcile.landed(frame(spark, list(rows)), current).first()["events_landed"]
    assert ask(row(version=1), row(start=T + timedelta(minutes=5), version=3)) == 2
    assert ask(row(version=2)) == 0 and ask() == 0
    assert ask(row(version=1), row(version=1)) == 2


NOW = datetime(2026, 10, 5, 12)
FILE = "report string, name string, published_at timestamp_ntz"


def listed(spark, *named, report="RealtimeTotals"):
    return spark.createDataFrame([(report, n, NOW) for n in named], FILE)


def test_reconcile_kinds_and_order(spark):
    name = "PUB_RealtimeTotals_2026100508_v{}.xml".format
    held = listed(spark, name(12))
    got = reconcile.find_changes(listed(spark, name(12), name(13)), held).collect()
    assert [(r["name"], r["kind"]) for r in got] == [(name(13), "new_version")]
    whole = reconcile.find_changes(listed(spark, *[name(i) for i in range(1, 13)]), listed(spark))
    assert [tuple(r) for r in reconcile.summarize(whole).collect()] == [("RealtimeTotals", 12, 0)]
    mixed = listed(spark, name(10), name(9), "PUB_RealtimeTotals_2026100507_v1.xml")
    assert [r["name"] for r in reconcile.oldest_first(reconcile.find_changes(mixed, listed(spark))).collect()] == [
        "PUB_RealtimeTotals_2026100507_v1.xml", name(9), name(10)]
    other = listed(spark, name(1), report="ICIDemand")  # another report's entry does not count
    assert reconcile.find_changes(listed(spark, name(1)), other).count() == 1
    back = reconcile.from_json(reconcile.to_json(whole))
    assert sorted(back.collect()) == sorted(whole.select("report", "name", "published_at", "kind").collect())


def test_newest_complete_group(spark):
    stamp = lambda hours: (NOW - timedelta(hours=hours)).strftime("%Y%m%d%H")
    named = [f"PUB_RealtimeTotals_{stamp(h)}_v{v}.xml" for h, n in ((100, 12), (80, 12), (50, 12), (75, 11), (10, 12)) for v in range(1, n + 1)]
    got = reconcile.newest_complete_group(listed(spark, *named), stamp(72)).collect()
    assert {r["file_group"] for r in got} == {f"PUB_RealtimeTotals_{stamp(80)}.xml"} and len(got) == 12


def test_runs_and_signals_are_kept_once(spark):
    run = "run_key string, events_sent bigint, recorded_at timestamp_ntz"
    first = spark.createDataFrame([("a", 12, NOW), ("b", 1, NOW)], run)
    again = spark.createDataFrame([("a", 0, NOW + timedelta(minutes=1))], run)
    assert sorted((r["run_key"], r["events_sent"]) for r in merge.upsert_runs(first, again).collect()) == [("a", 0), ("b", 1)]
    signal = "zone string, variant string, candidate_hour timestamp_ntz, decided_at timestamp_ntz, margin double, evaluated_at timestamp_ntz"
    rows = spark.createDataFrame([("Z", "persist2", T, T, 1.0, NOW), ("Z", "persist2", T, T, 1.0, NOW), ("Z", "persist4", T, T, 1.0, NOW)], signal)
    stored = merge.new_signals(rows.limit(0), rows)
    assert stored.count() == 2 and merge.new_signals(stored, rows).count() == 0
