"""Counters of whole jobs against what was put into them."""

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.functions import events
from peakledger.plans import ingest
from peakledger.sources import files
from peakledger.streaming import consumer, counters, producer, topics
from peakledger.streaming.warehouse import Warehouse
from tests import samples

DAY, AT = date(2026, 9, 28), datetime(2026, 9, 28, 13)


def land(root, hour=8, versions=3):
    for v in range(1, versions + 1):
        samples.write(root, "RealtimeTotals", f"PUB_RealtimeTotals_20260928{hour:02d}_v{v}.xml", samples.realtime(DAY, hour, [16000.0 + i for i in range(v)]))


def totals(spark, folder):
    return {(r["source"], r["report"]): r.asDict() for r in counters.totals(counters.rows(spark, str(folder))).collect()}


def test_one_table_counts_files_and_events_of_producer_and_consumer(spark, tmp_path):
    root, house, metrics = tmp_path / "land", Warehouse(spark, str(tmp_path / "house")), tmp_path / "metrics"
    land(root)
    samples.write(root, "ICIDemand", "PUB_ICIDemand_2026_v1.csv", samples.ici_demand(DAY, 2))
    samples.write(root, "ICIDemand", "PUB_ICIDemand_2026_v2.csv", "broken")
    go = lambda batch: ingest.run(files.list_files(spark, str(root)), house, str(tmp_path / "topics"), "live", AT, batch, metrics=str(metrics))
    go("one")
    go("two")
    bad = spark.createDataFrame([("k", "not json", events.TOPIC["ICIDemand"])], topics.MESSAGE)
    topics.send(bad, str(tmp_path / "topics"), "bad")
    query = consumer.run(spark, str(tmp_path / "topics"), house, str(tmp_path / "cp"), str(tmp_path / "aside"), metrics=str(metrics))
    query.awaitTermination()
    assert query.exception() is None
    got = totals(spark, metrics)
    pick = lambda key: [got[key][c] for c in ("batches", "files_seen", *counters.SUMS)]
    # 1 + 2 + 3 readings in three files, 3 of them news; the second pass skips all good files and opens the broken one again
    assert pick(("producer-live", "RealtimeTotals")) == [2, 6, 3, 0, 3, 3, 3, 0, 0]
    assert pick(("producer-live", "ICIDemand")) == [2, 4, 1, 2, 1, 48, 0, 0, 0]
    assert pick(("demand", None))[-2:] == [1, 51]
    newest = house.raw().agg(F.max("published_at")).first()[0]
    as_of = F.lit(str(newest + timedelta(seconds=90))).cast("timestamp_ntz")
    health = {r["source"]: r for r in counters.health(counters.rows(spark, str(metrics)), as_of).collect()}
    assert health["demand"]["age_s"] == 90.0 and health["demand"]["batch_p95_s"] > 0 and health["demand"]["events_per_second"] > 0


def test_events_that_break_the_contract_are_counted_and_nothing_is_sent(spark, tmp_path):
    land(tmp_path / "land")
    house = Warehouse(spark, str(tmp_path / "house"))
    with pytest.raises(ValueError, match="3 events break the contract"):
        ingest.run(files.list_files(spark, str(tmp_path / "land")), house, str(tmp_path / "topics"), "no such reason", AT, "one", metrics=str(tmp_path / "m"))
    row = totals(spark, tmp_path / "m")[("producer-no such reason", "RealtimeTotals")]
    assert (row["events_produced"], row["events_deduplicated"], row["events_invalid"], row["files_parsed"]) == (0, 3, 3, 3)
    assert not (tmp_path / "topics").exists()


def test_the_file_stream_counts_each_batch_and_its_progress_is_kept(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    land(root, versions=4)
    listener = counters.ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        query = producer.run(spark, str(root), house, str(tmp_path / "topics"), str(tmp_path / "cp"), name="files in", now=lambda: AT,
                             files_per_batch=2, metrics=str(tmp_path / "m"))
        query.awaitTermination()
        assert query.exception() is None
        stop = time.monotonic() + 60
        while len(list((tmp_path / "progress").glob("query=*/run=*/batch=*/_SUCCESS"))) < 2 and time.monotonic() < stop:
            time.sleep(0.2)  # listeners are told after the batch
    finally:
        spark.streams.removeListener(listener)
    row = totals(spark, tmp_path / "m")[("producer-live", "RealtimeTotals")]
    assert (row["batches"], row["files_parsed"], row["events_produced"], row["events_deduplicated"]) == (2, 4, 4, 6)
    kept = counters.progress(spark, str(tmp_path / "progress")).orderBy("batch_id").collect()
    want = [(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
    assert [(r["batch_id"], r["input_rows"]) for r in kept] == want and {r["query"] for r in kept} == {"files in"}
