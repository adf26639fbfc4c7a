"""Whole jobs, each on a folder of generated files."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.functions import events
from peakledger.functions.events import EVENT_COLUMNS
from peakledger.operators import changes, merge
from peakledger.plans import ingest, reconciliation
from peakledger.sources import files
from peakledger.streaming import consumer, evaluator, producer, stateful, topics
from peakledger.streaming.warehouse import DONE, HANDLED, STATE, Warehouse
from tests import samples

DAY = date(2026, 9, 28)
AT = datetime(2026, 9, 28, 13)
NAME = "PUB_RealtimeTotals_20260928{:02d}_v{}.xml".format


def land(root, hours=(8,), versions=12):
    """Version N holds the first N intervals of the hour."""
    for hour in hours:
        for v in range(1, versions + 1):
            samples.write(root, "RealtimeTotals", NAME(hour, v), samples.realtime(DAY, hour, [16000.0 + hour + i for i in range(v)]))


def counts(result):
    return result["events_produced"], result["events_deduplicated"]


def sent(spark, root):
    return spark.read.parquet(root)


def consume(spark, tmp, house, checkpoint="cp", **more):
    query = consumer.run(spark, str(tmp / "topics"), house, str(tmp / checkpoint), str(tmp / "bad"), **more)
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_from_files_to_tables_and_a_replay(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    land(root)
    samples.write(root, "PredispTotals", "PUB_PredispTotals_20260928_v1.xml", samples.predisp_xml(DAY, [15000.0 + h for h in range(24)]))
    samples.write(root, "ICIDemand", "PUB_ICIDemand_2026_v1.csv", samples.ici_demand(DAY, 2))
    samples.write(root, "ICIDemand", "PUB_ICIDemand_2026_v2.csv", "broken")
    run = lambda batch: ingest.run(files.list_files(spark, str(root)), house, str(tmp_path / "topics"), "backfill", AT, batch)
    first = run("one")
    assert counts(first) == (12 + 24 + 48, 66)  # 78 readings in the twelve files, 12 of them new
    assert first["files"][("ICIDemand", "files_failed")] == 1 and first["files"][("RealtimeTotals", "files_parsed")] == 12
    again = run("two")  # a restart sends nothing; the bad file is tried again
    assert counts(again) == (0, 0) and again["files"][("RealtimeTotals", "files_skipped")] == 12
    # a re-issued hour: one changed value is one event, the rest is not news
    samples.write(root, "RealtimeTotals", NAME(8, 13), samples.realtime(DAY, 8, [16008.0, 1.5] + [16008.0 + i for i in range(2, 12)]))
    assert counts(run("three")) == (1, 11)

    consume(spark, tmp_path, house, metrics=str(tmp_path / "metrics"), files_per_batch=2)
    assert house.raw().count() == 85 and house.current().count() == 84
    fixed = house.current().where(F.col("version") == 13).first()
    assert fixed["value_mw"] == 1.5 and fixed["interval_start"] == datetime(2026, 9, 28, 12, 5)
    total = spark.read.json(str(tmp_path / "metrics")).agg(F.sum("events_written"), F.sum("events_invalid")).first()
    assert tuple(total) == (85, 0)

    before = merge.checksum(house.raw()).first(), merge.checksum(house.current()).first()
    house.truncate()
    consume(spark, tmp_path, house, "cp-replay")  # under the same name, with batch numbers from zero again
    assert (merge.checksum(house.raw()).first(), merge.checksum(house.current()).first()) == before


def test_bad_messages_are_kept_aside_and_never_block(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    row = (*["RealtimeTotals", "ontario_demand", datetime(2026, 9, 28, 12), "ONTARIO", 1, 5.0, AT, AT, "raw/x", "a" * 64, "live"],)
    schema = ("report string, measure string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
              "ingested_at timestamp_ntz, source_uri string, content_sha256 string, reason string")
    good = topics.routed(spark.createDataFrame([row], schema))
    bad = spark.createDataFrame([("k", "not json", events.TOPIC["ICIDemand"]), ("k", json.dumps({"junk": 1}), events.TOPIC["ICIDemand"])], topics.MESSAGE)
    no_such_month = good.withColumn("value", F.replace("value", F.lit("2026-09-28T12"), F.lit("2026-13-28T12")))
    topics.send(good.unionByName(bad.select("key", "value", "topic")).unionByName(no_such_month), str(tmp_path / "topics"), "b")
    query = consume(spark, tmp_path, house)
    assert house.raw().count() == 1
    aside = spark.read.parquet(str(tmp_path / "bad"))
    assert aside.count() == 3 and aside.where(F.array_contains("violations", "interval_start")).count() == 1
    assert consumer.progress_rows(spark, query).agg(F.sum("input_rows")).first()[0] == 4
    consume(spark, tmp_path, house, "cp-other")  # a replay keeps what the first run set aside
    assert spark.read.parquet(str(tmp_path / "bad")).groupBy("run").count().count() == 2


def test_the_file_stream_takes_each_file_once(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    land(root, hours=(8,), versions=3)
    def go():
        query = producer.run(spark, str(root), house, str(tmp_path / "topics"), str(tmp_path / "cp"), now=lambda: AT)
        query.awaitTermination()
        assert query.exception() is None
    go()
    assert sent(spark, str(tmp_path / "topics")).count() == 3
    land(root, hours=(9,), versions=2)
    go()
    assert sent(spark, str(tmp_path / "topics")).count() == 5
    assert house.rows(DONE).count() == 5 and house.state().count() == 5


def test_a_replay_is_cut_into_batches_of_bounded_size(spark, tmp_path, monkeypatch):
    message = spark.createDataFrame([("k", "not json", events.TOPIC["ICIDemand"])], topics.MESSAGE)
    for batch in "abc":
        topics.send(message, str(tmp_path / "topics"), batch)
    monkeypatch.setattr(topics, "BATCH_BYTES", 1)
    query = consume(spark, tmp_path, Warehouse(spark, str(tmp_path / "house")))
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]


@pytest.fixture
def typed_state(spark):
    before = spark.conf.get(stateful.STORE[0])
    spark.conf.set(*stateful.STORE)
    yield
    spark.conf.set(stateful.STORE[0], before)


def test_stateful_stream_goes_on_where_a_table_left_off(spark, tmp_path, typed_state):
    rng, t0 = random.Random(2), datetime(2026, 9, 28, 12)
    schema = ("report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
              "ingested_at timestamp_ntz, source_uri string")
    rows = [("RealtimeTotals", t0 + timedelta(minutes=5 * rng.randint(0, 4)), "ONTARIO", rng.randint(1, 6), float(rng.randint(1, 3)), t0,
             t0 + timedelta(minutes=m), f"f{m}") for m in range(90)]
    early, late = spark.createDataFrame(rows[:50], schema), spark.createDataFrame(rows[50:], schema)
    changes.moved_state(changes.news_in_arrival_order(early)).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    for i in range(2):
        spark.createDataFrame(rows[50 + 20 * i:70 + 20 * i], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (stateful.news_stream(stream, state).writeStream.outputMode("append").format("memory").queryName("seeded_news")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    columns = ["interval_start", "version", "value_mw", "ingested_at", "state_version", "state_value"]
    pick = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    got = pick(spark.table("seeded_news"))
    assert got == pick(changes.news_in_arrival_order(late, state)) and len(got) < len(pick(changes.news_in_arrival_order(late)))


def test_stateful_stream_equals_its_batch_twin(spark, tmp_path, typed_state):
    rng = random.Random(1)
    schema = ("report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
              "ingested_at timestamp_ntz, source_uri string")
    t0 = datetime(2026, 9, 28, 12)
    rows = [("RealtimeTotals", t0 + timedelta(minutes=5 * rng.randint(0, 4)), "ONTARIO", rng.randint(1, 6), float(rng.randint(1, 3)), t0,
             t0 + timedelta(minutes=m), f"f{m}") for m in range(120)]
    for i in range(3):  # three files, taken one per micro-batch, in order
        spark.createDataFrame(rows[40 * i:40 * i + 40], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (stateful.news_stream(stream).writeStream.outputMode("append").format("memory").queryName("news_out")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    columns = ["interval_start", "version", "value_mw", "ingested_at", "state_version", "state_value"]
    pick = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert pick(spark.table("news_out")) == pick(changes.news_in_arrival_order(spark.createDataFrame(rows, schema)))


def test_reconciliation_finds_sends_and_records_a_missed_hour(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    land(root, hours=(7, 8))
    listed = files.list_files(spark, str(root)).withColumn("published_at", F.lit(datetime(2026, 9, 28, 14)).cast("timestamp_ntz")).persist()
    ingest.run(listed, house, str(tmp_path / "topics"), "live", AT, "one")
    consume(spark, tmp_path, house)
    before = house.current().select("interval_start", "version", "value_mw").orderBy("interval_start").collect()
    reconciliation.seed(house, "2026092808", listed)
    assert house.current().count() == 12 and house.rows(DONE).count() == 12 and house.state().count() == 12
    start, end = datetime(2026, 9, 28, 8), datetime(2026, 9, 29, 8)
    turn = iter(range(9))
    go = lambda: reconciliation.run(spark, listed, house, str(tmp_path / "topics"), start, end, datetime(2026, 9, 29, 8, 5),
                                    deliver=lambda: consume(spark, tmp_path, house, f"cp-catch-up-{next(turn)}"))
    out = go()
    assert out["failure"] is None
    run = out["run"]
    assert (run["listed_files"], run["new_group_files"], run["new_version_files"], run["files_processed"]) == (24, 12, 0, 12)
    assert (run["events_sent"], run["events_landed"], run["files_with_new_values"], run["status"]) == (12, 12, 12, "ok")
    assert house.current().select("interval_start", "version", "value_mw").orderBy("interval_start").collect() == before
    assert house.rows(HANDLED).count() == 12 and house.rows(STATE).count() >= 12
    events_before = sorted(map(tuple, sent(spark, str(tmp_path / "topics")).select("key", "value").collect()))
    second = go()["run"]  # nothing left; the run's row is replaced, and what the first run sent stays
    assert sorted(map(tuple, sent(spark, str(tmp_path / "topics")).select("key", "value").collect())) == events_before
    assert (second["new_group_files"], second["events_sent"], second["status"]) == (0, 0, "ok")
    assert [(r["run_key"], r["events_sent"]) for r in house.runs().collect()] == [(start.isoformat(), 0)]
    assert out["quality"]["current_matches_raw"] == 0 and out["quality"]["duplicate_keys"] == 0


def test_a_failed_reconciliation_still_leaves_its_row(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    land(root, hours=(7,), versions=2)
    samples.write(root, "RealtimeTotals", NAME(9, 1), "<broken")
    listed = files.list_files(spark, str(root)).withColumn("published_at", F.lit(datetime(2026, 9, 28, 14)).cast("timestamp_ntz"))
    def fail():
        raise TimeoutError("consumer is down")
    out = reconciliation.run(spark, listed, house, str(tmp_path / "topics"), datetime(2026, 9, 28, 8), datetime(2026, 9, 29, 8), AT, deliver=fail)
    assert isinstance(out["failure"], TimeoutError) and out["run"]["status"] == "needs_attention" and out["run"]["files_failed"] == 1
    assert house.runs().count() == 1 and house.rows(HANDLED).count() == 0


def test_the_last_hours_of_april_belong_to_the_old_base_period(spark, tmp_path):
    est = lambda *a: datetime(*a) + timedelta(hours=5)
    schema = ("report string, measure string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
              "ingested_at timestamp_ntz, source_uri string, content_sha256 string, reason string")
    def event(t, mw, reason="backfill"):
        return ("ICIDemand", "ontario_demand", t, "ONTARIO", 1, mw, t, t + timedelta(minutes=75), "raw/x", "a" * 64, reason)
    rows = [event(est(2025, 7, d, 12), 24000.0) for d in range(1, 11)] + [event(est(2026, 4, d, 12), 15000.0) for d in range(1, 30)]
    newest = est(2026, 4, 30, 21)  # hour-ending 22 in April, 1 May in UTC
    topics.send(topics.routed(spark.createDataFrame(rows, schema)), str(tmp_path / "topics"), "history")
    topics.send(topics.routed(spark.createDataFrame([event(newest, 16000.0, "live")], schema)), str(tmp_path / "topics"), "live")
    params = spark.createDataFrame([("ONTARIO", "persist2", 1.0, [4], 20, 24)], "zone string, variant string, margin double, months array<int>, he_min int, he_max int")
    house = Warehouse(spark, str(tmp_path / "history"))
    evaluator.run(spark, str(tmp_path / "topics"), house, params, str(tmp_path / "cp"), str(tmp_path / "out"), now=lambda: newest + timedelta(minutes=75)).awaitTermination()
    got = house.signals().collect()
    assert [(r["candidate_hour"], r["estimate_mw"], r["bar_mw"], r["risk"]) for r in got] == [(est(2026, 4, 30, 23), 16000.0, 24000.0, False)]


def test_live_signals_are_written_once(spark, tmp_path):
    rng = random.Random(2)
    est = lambda *a: datetime(*a) + timedelta(hours=5)
    latest, now = est(2025, 6, 23, 23), est(2025, 6, 24, 0) + timedelta(minutes=15)
    schema = ("report string, measure string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
              "ingested_at timestamp_ntz, source_uri string, content_sha256 string, reason string")
    rows = [("ICIDemand", "ontario_demand", t, "ONTARIO", 1, float(rng.randint(15000, 24000)), t, t, "raw/x", "a" * 64, "backfill")
            for t in (est(2025, 5, 1) + timedelta(hours=i) for i in range(54 * 24 - 1))]
    live = ("ICIDemand", "ontario_demand", latest, "ONTARIO", 1, 23000.0, now, now, "raw/y", "b" * 64, "live")
    topics.send(topics.routed(spark.createDataFrame(rows, schema)), str(tmp_path / "topics"), "history")
    topics.send(topics.routed(spark.createDataFrame([live], schema)), str(tmp_path / "topics"), "live")
    params = spark.createDataFrame([("ONTARIO", v, m, [6, 7, 8, 9], 11, 19) for v, m in (("persist2", 0.98), ("persist4", 0.99), ("day_ahead", 0.9))],
                                   "zone string, variant string, margin double, months array<int>, he_min int, he_max int")
    house = Warehouse(spark, str(tmp_path / "history"))
    for attempt in ("a", "b"):  # the second start replays the topic from its beginning
        query = evaluator.run(spark, str(tmp_path / "topics"), house, params, str(tmp_path / f"cp-{attempt}"), str(tmp_path / "out"),
                              name=f"signals-{attempt}", now=lambda: now)
        query.awaitTermination()
        assert query.exception() is None
    got = house.signals().collect()
    assert len(got) == 2 + 9
    ahead = [r for r in got if r["variant"] == "day_ahead"]
    peak = max(r[5] for r in rows if (r[2] - timedelta(hours=5)).date() == date(2025, 6, 23))
    assert {r["estimate_mw"] for r in ahead} == {max(peak, 23000.0)} and all(r["bar_mw"] for r in ahead)
    assert spark.read.parquet(str(tmp_path / "out" / "signals-a")).count() == 11
    assert EVENT_COLUMNS[0] == "report"
