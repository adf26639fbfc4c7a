import hashlib
import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.functions import contract, events, names
from peakledger.sources import files, listing, reports
from tests import samples

DAY = date(2026, 9, 28)
LOADS = [15000.0 + 10.5 * h for h in range(24)]


def parsed(spark, named):
    rows = [(n.split("_")[1], n, text) for n, text in named.items()]
    return {r["name"]: r for r in reports.parse(spark.createDataFrame(rows, "report string, name string, text string")).collect()}


def test_five_minute_files(spark):
    good = samples.realtime(DAY, 8, [16087.9 + i for i in range(12)])
    texts = {"ok_v12": good, "prefix_v3": samples.realtime(DAY, 24, [1.0, 2.0, 3.0]), "cut_v1": good[:700], "none_v1": samples.realtime(DAY, 8, []),
             "order_v2": good.replace("<Interval>2<", "<Interval>3<"), "hour_v2": samples.realtime(DAY, 25, [1.0]),
             "miss_v2": good.replace("ONTARIO DEMAND", "OTHER", 1), "text_v2": good.replace("<EnergyMW>16087.9<", "<EnergyMW>n/a<")}
    got = parsed(spark, {f"PUB_RealtimeTotals_{k}.xml": v for k, v in texts.items()})
    row = got["PUB_RealtimeTotals_ok_v12.xml"]
    assert row["error"] is None and len(row["rows"]) == 12
    assert row["rows"][0]["interval_start"] == datetime(2026, 9, 28, 12) and row["rows"][1]["interval_start"] == datetime(2026, 9, 28, 12, 5)
    assert row["rows"][11]["value_mw"] == 16098.9 and row["rows"][11]["total_load_mw"] == 17098.9
    assert [r["interval_start"] for r in got["PUB_RealtimeTotals_prefix_v3.xml"]["rows"]][0] == datetime(2026, 9, 29, 4)
    errors = {k: got[f"PUB_RealtimeTotals_{k}.xml"]["error"] for k in texts if k not in ("ok_v12", "prefix_v3")}
    assert errors == {"cut_v1": "not well-formed", "none_v1": "no interval blocks", "order_v2": "intervals do not count up from 1",
                      "hour_v2": "day or hour unreadable", "miss_v2": "quantity missing or unreadable", "text_v2": "quantity missing or unreadable"}


def test_forecast_files_say_the_same_in_both_forms(spark):
    xml, csv = samples.predisp_xml(DAY, LOADS), samples.predisp_csv(DAY, LOADS)
    named = {"PUB_PredispTotals_a_v1.xml": xml, "PUB_PredispTotals_a_v1.csv": csv, "PUB_PredispTotals_b_v1.xml": samples.predisp_xml(DAY, LOADS[:-3]),
             "PUB_PredispTotals_b_v1.csv": samples.predisp_csv(DAY, LOADS[:-3]), "PUB_PredispTotals_c_v1.csv": csv.replace(",7\r\n", "\r\n", 1),
             "PUB_PredispTotals_d_v1.csv": "x\n" + csv, "PUB_PredispTotals_e_v1.csv": csv.replace(" FOR ", " "), "PUB_PredispTotals_f_v1.xml": xml[:600],
             "PUB_PredispTotals_a.xml": xml}
    got = parsed(spark, named)
    assert got["PUB_PredispTotals_a_v1.xml"]["rows"] == got["PUB_PredispTotals_a_v1.csv"]["rows"]
    rows = got["PUB_PredispTotals_a_v1.csv"]["rows"]
    assert len(rows) == 24 and rows[0]["interval_start"] == datetime(2026, 9, 28, 5) and rows[18]["value_mw"] == LOADS[18]
    assert got["PUB_PredispTotals_b_v1.xml"]["error"] == got["PUB_PredispTotals_b_v1.csv"]["error"] == "hours do not run from 1 to 24"
    assert got["PUB_PredispTotals_c_v1.csv"]["error"].startswith("line 6: unreadable row")
    assert "first lines" in got["PUB_PredispTotals_d_v1.csv"]["error"] and "names no day" in got["PUB_PredispTotals_e_v1.csv"]["error"]
    assert got["PUB_PredispTotals_f_v1.xml"]["error"] == "not well-formed" and "not a versioned file" in got["PUB_PredispTotals_a.xml"]["error"]


def test_hourly_year_files(spark):
    whole = samples.ici_demand(date(2022, 5, 1), 365)
    head = "\n".join(whole.splitlines()[:4])
    named = {"PUB_ICIDemand_2022_v1.csv": whole, "PUB_ICIDemand_2022_v2.csv": head, "PUB_ICIDemand_2022_v3.csv": whole.rstrip("\n").rsplit(",", 1)[0],
             "PUB_ICIDemand_2022_v4.csv": whole.replace(",24,", ",25,", 1), "PUB_ICIDemand_2022_v5.csv": "", "PUB_ICIDemand_2022_v6.csv": whole.replace("\n", "\r\n")}
    got = parsed(spark, named)
    rows = got["PUB_ICIDemand_2022_v1.csv"]["rows"]
    assert len(rows) == 8760
    assert all(b["interval_start"] - a["interval_start"] == timedelta(hours=1) for a, b in zip(rows, rows[1:]))
    assert sum(r["delivery_date"] == date(2022, 11, 6) for r in rows) == 24
    errors = [got[f"PUB_ICIDemand_2022_v{i}.csv"]["error"] for i in range(2, 6)]
    assert errors[0] == "no rows below the header" and errors[1].startswith("line 8764: unreadable row")
    assert errors[2].startswith("line 28: unreadable row") and "first lines" in errors[3]
    assert got["PUB_ICIDemand_2022_v6.csv"]["rows"] == rows


def test_peak_tracker(spark):
    peaks = [(date(2022, 7, 19), 18, 22607.3666666667), (date(2022, 6, 22), 17, 21953.98), (date(2022, 8, 29), 17, 21870.7)]
    texts = {"a": samples.tracker(peaks), "b": samples.tracker(peaks, name="OTHER"), "c": samples.tracker([]), "d": samples.tracker(peaks)[:800]}
    frame = spark.createDataFrame(list(texts.items()), "name string, text string")
    got = {}
    for r in reports.parse_tracker(frame).collect():
        got.setdefault(r["name"], []).append(r)
    top = sorted(got["a"], key=lambda r: r["rank"])
    assert [(r["rank"], r["delivery_date"], r["hour_ending"], r["demand_mw"], r["status"]) for r in top] == [
        (i, *p, "Final") for i, p in enumerate(peaks, 1)]
    assert top[0]["interval_start"] == datetime(2022, 7, 19, 22)
    assert [got[k][0]["error"] for k in "bcd"] == ["not exactly one set of demand peaks", "the set holds no peaks", "not well-formed"]


def test_events_of_a_file(spark):
    text = samples.realtime(DAY, 8, [16087.9, 16090.0])
    frame = spark.createDataFrame([("RealtimeTotals", "PUB_RealtimeTotals_2026092808_v2.xml", datetime(2026, 9, 28, 12, 54, 48), "raw/x", text)],
                                  "report string, name string, published_at timestamp_ntz, uri string, text string")
    made = reports.to_events(reports.parse(frame), "live", F.lit("2026-09-28 12:56:00").cast("timestamp_ntz")).collect()
    points = [["2026-09-28T12:00:00Z", 16087.9], ["2026-09-28T12:05:00Z", 16090.0]]
    assert {e["content_sha256"] for e in made} == {hashlib.sha256(json.dumps(points).encode()).hexdigest()}
    assert [(e["version"], e["measure"], e["zone"], e["reason"], e["file_group"]) for e in made] == [
        (2, "ontario_demand", "ONTARIO", "live", "PUB_RealtimeTotals_2026092808.xml")] * 2


def test_listing_and_names(spark):
    pages = spark.createDataFrame([("ICIPeakTracker", samples.LISTING)], "report string, html string")
    got = {r["name"]: r["published_at"] for r in listing.entries(pages).collect()}
    assert got["PUB_ICIPeakTracker_2023_v47.xml"] == datetime(2024, 2, 5, 13, 40)
    assert got["PUB_ICIPeakTracker_2025_v106.xml"] == datetime(2026, 1, 1, 2, 25) and len(got) == 3
    assert listing.links(pages).count() == 3
    assert {r["name"] for r in listing.wanted(listing.links(pages)).collect()} == {
        "PUB_ICIPeakTracker_2023_v47.xml", "PUB_ICIPeakTracker_2025_v106.xml"}
    row = spark.sql("SELECT 'PUB_ICIDemand_2026_v3571.csv' AS n, 'PUB_RealtimeTotals_2026092808_v12.xml' AS r, 'PUB_X.xml' AS b").select(
        names.version_of(F.col("n")).alias("v"), names.group_of(F.col("n")).alias("g"), names.stamp_of(names.group_of(F.col("r"))).alias("s"),
        names.version_of(F.col("b")).alias("none"), names.is_wanted(F.lit("ICIDemand"), F.col("n")).alias("yes"),
        names.is_wanted(F.lit("RealtimeTotals"), F.col("n")).alias("no")).first()
    assert tuple(row) == (3571, "PUB_ICIDemand_2026.csv", "2026092808", None, True, False)
    key = spark.sql("SELECT timestamp_ntz'2026-09-29 03:00:00' AS s").select(
        events.routing_key(F.lit("RealtimeTotals"), F.lit("ONTARIO"), F.col("s"))).first()[0]
    assert key == "RealtimeTotals|ONTARIO|2026-09-28"  # market date, not the UTC date


def test_folders_manifest_and_archive(spark, tmp_path):
    text = samples.realtime(DAY, 8, [1.0])
    for name in ("PUB_RealtimeTotals_2026092808_v1.xml", "PUB_RealtimeTotals_2026092808_v2.xml", "PUB_RealtimeTotals_2026092808.xml"):
        samples.write(tmp_path / "land", "RealtimeTotals", name, text)
    saved = spark.createDataFrame([("RealtimeTotals", "PUB_RealtimeTotals_2026092808_v1.xml", datetime(2026, 1, 1))],
                                  "report string, name string, published_at timestamp_ntz")
    listed = files.list_files(spark, str(tmp_path / "land"), saved)
    got = {r["name"]: r["published_at"] for r in listed.collect()}
    assert set(got) == {"PUB_RealtimeTotals_2026092808_v1.xml", "PUB_RealtimeTotals_2026092808_v2.xml"}  # the base file is refused
    assert got["PUB_RealtimeTotals_2026092808_v1.xml"] == datetime(2026, 1, 1) and got["PUB_RealtimeTotals_2026092808_v2.xml"].year > 2025
    assert {r["text"] for r in files.read_texts(listed).collect()} == {text} == {r["text"] for r in files.read_folder(spark, str(tmp_path / "land")).collect()}
    held = spark.createDataFrame([("RealtimeTotals", "PUB_RealtimeTotals_2026092808_v2.xml")], "report string, name string")
    copied = files.archive(listed, held, str(tmp_path / "archive"))
    assert [r["name"] for r in copied.collect()] == ["PUB_RealtimeTotals_2026092808_v1.xml"]
    kept = files.read_archive(spark, str(tmp_path / "archive")).collect()
    assert [(r["name"], r["published_at"], r["text"]) for r in kept] == [("PUB_RealtimeTotals_2026092808_v1.xml", datetime(2026, 1, 1), text)]


GOOD = {"schema_version": 1, "report": "RealtimeTotals", "measure": "ontario_demand", "interval_start": "2026-09-28T12:00:00Z", "zone": "ONTARIO",
        "version": 12, "value_mw": 16087.9, "published_at": "2026-09-28T13:20:05Z", "ingested_at": "2026-09-28T13:21:30Z", "source_uri": "raw/x",
        "content_sha256": "a" * 64, "reason": "live"}


def test_contract(spark):
    def changed(**more):
        return json.dumps({**GOOD, **more})
    cases = {
        json.dumps(GOOD): [], changed(value_mw=16087): [], changed(version=12.0): [], changed(value_mw=1e3): [],
        "not json": ["not_an_object"], "[1]": ["not_an_object"], "17": ["not_an_object"],
        changed(value_mw="16087.9"): ["value_mw"], changed(value_mw=None): ["value_mw"], changed(value_mw=True): ["value_mw"],
        changed(version=0): ["version"], changed(version=1.5): ["version"], changed(version="1"): ["version"], changed(schema_version=2): ["schema_version"],
        changed(zone="OTHER"): ["zone"], changed(report="X"): ["report"], changed(measure="x"): ["measure"], changed(reason="x"): ["reason"],
        changed(interval_start="2026-09-28 12:00:00"): ["interval_start"], changed(published_at="2026-09-28T12:00Z"): ["published_at"],
        changed(content_sha256="A" * 64): ["content_sha256"], changed(source_uri=""): ["source_uri"], changed(source_uri=5): ["source_uri"],
        changed(note=1): ["extra_field"],
        json.dumps({k: v for k, v in GOOD.items() if k != "reason"}): ["missing_field"],
    }
    frame = contract.check(spark.createDataFrame([(k,) for k in cases] + [('{"junk": 1}',)], "value string"))
    got = {r["value"]: r["violations"] for r in frame.select("value", "violations").collect()}
    assert got.pop('{"junk": 1}') == ["missing_field", "extra_field"]
    assert got == cases
    rows = contract.decode(frame).collect()
    assert len(rows) == 4 and rows[0]["interval_start"] == datetime(2026, 9, 28, 12) and {r["version"] for r in rows} == {12}


@pytest.mark.parametrize(("uri", "store", "path"), [
    ("file:/a/b c", "file:///", "/a/b c"), ("file:///a/b", "file:///", "/a/b"), ("s3a://bucket/d/f.xml", "s3://bucket", "d/f.xml"),
    ("s3://bucket/f", "s3://bucket", "f"), ("hdfs://one:8020/d/f", "hdfs://one:8020", "d/f"), ("hdfs:///d/f", "hdfs://", "d/f")])
def test_a_file_is_looked_for_in_its_own_store(uri, store, path):
    assert files.place_of(uri) == (store, path)
