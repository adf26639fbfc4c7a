"""The stream over index pages: each file once, in the batch of its time, whatever the page held before."""

from datetime import date, datetime, timedelta, timezone

import pytest

from peakledger.sources import listing_stream
from peakledger.streaming import producer
from peakledger.streaming.warehouse import DONE, Warehouse
from tests import samples

NAME = "PUB_RealtimeTotals_20260102{:02d}_v{}.xml".format
MARKET = timedelta(hours=-5)


def page(root, report, entries):
    lines = "".join(f'<a href="{n}">{n}</a>   {(t + MARKET):%d-%b-%Y %H:%M}  7K\n' for n, t in entries)
    samples.write(root, report, listing_stream.PAGE, f"<pre>{lines}</pre>")


def now():
    return datetime.now(timezone.utc).replace(tzinfo=None, second=0, microsecond=0)


def take(spark, tmp, root, **options):
    """Names of the stream's new rows, under one checkpoint."""
    out = []
    def keep(batch, _):
        out.extend(tuple(r) for r in batch.select("report", "name", "published_at").collect())
    query = (listing_stream.listed(spark, str(root), **options).writeStream.foreachBatch(keep)
             .option("checkpointLocation", str(tmp / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert query.exception() is None
    return sorted(out)


def test_entries_of_a_page():
    got = dict(listing_stream.entries_of(samples.LISTING))
    assert got["PUB_ICIPeakTracker_2025_v106.xml"] == datetime(2026, 1, 1, 2, 25) and len(got) == 3
    assert list(listing_stream.entries_of("")) == []
    line = '<a href="PUB_A_v1.xml">A</a>  99-Foo-2026 08:40\n<a href="PUB_B_v1.xml">B</a>  01-Feb-2026 08:40\n'
    assert [n for n, _ in listing_stream.entries_of(line + line)] == ["PUB_B_v1.xml"]


def test_a_restart_lists_only_new_files(spark, tmp_path):
    root, old = tmp_path / "land", now() - timedelta(days=30)
    first = [(NAME(8, v), old + timedelta(minutes=5 * v)) for v in (1, 2)]
    page(root, "RealtimeTotals", first + [("PUB_RealtimeTotals_2026010208.xml", old), (NAME(23, 1), now() + timedelta(hours=1))])
    page(root, "ICIDemand", [("PUB_ICIDemand_2026_v1.csv", old), ("PUB_ICIDemand_2026_v1.xml", old)])
    reports = ["RealtimeTotals", "ICIDemand", "ICIDemand"]
    # unversioned, of another format, or not yet published: none of these
    want = sorted([("RealtimeTotals", n, t) for n, t in first] + [("ICIDemand", "PUB_ICIDemand_2026_v1.csv", old)])
    assert take(spark, tmp_path, root, reports=reports, settle_minutes=60) == want
    assert take(spark, tmp_path, root, reports=reports, settle_minutes=60) == []
    # 30 minutes ago is after the first batch's end, an hour ago; an entry that claims an old time is the reconciliation's
    fresh = (NAME(9, 1), now() - timedelta(minutes=30))
    page(root, "RealtimeTotals", first + [fresh, (NAME(7, 1), old)])
    assert take(spark, tmp_path, root, reports=reports, settle_minutes=2) == [("RealtimeTotals", *fresh)]


def test_since_is_exclusive(spark, tmp_path):
    root, at = tmp_path / "land", datetime(2026, 1, 2, 13)
    page(root, "RealtimeTotals", [(NAME(8, v), at + timedelta(minutes=v)) for v in (0, 1, 2)])
    got = take(spark, tmp_path, root, reports=["RealtimeTotals"], since=at)
    assert [n for _, n, _ in got] == [NAME(8, 1), NAME(8, 2)]


def test_a_page_that_cannot_be_read_stops_the_batch(spark, tmp_path):
    page(tmp_path / "land", "RealtimeTotals", [])
    with pytest.raises(Exception, match="index.html"):
        take(spark, tmp_path, tmp_path / "land", reports=["RealtimeTotals", "PredispTotals"])
    page(tmp_path / "land", "PredispTotals", [("PUB_PredispTotals_20260102_v1.xml", datetime(2026, 1, 2))])
    assert len(take(spark, tmp_path, tmp_path / "land", reports=["RealtimeTotals", "PredispTotals"])) == 1


def test_the_producer_follows_the_pages(spark, tmp_path):
    root, house = tmp_path / "land", Warehouse(spark, str(tmp_path / "house"))
    at = now() - timedelta(days=20)
    def land(hour):
        samples.write(root, "RealtimeTotals", NAME(hour, 1), samples.realtime(date(2026, 1, 2), hour, [16000.0 + i for i in range(12)]))
        return NAME(hour, 1)
    def go(settle):
        query = producer.run(spark, str(root), house, str(tmp_path / "topics"), str(tmp_path / "cp-producer"), now=lambda: at,
                             listing={"reports": ["RealtimeTotals"], "settle_minutes": settle})
        query.awaitTermination()
        assert query.exception() is None
    entries = [(land(8), at)]
    page(root, "RealtimeTotals", entries)
    go(60)
    entries.append((land(9), now() - timedelta(minutes=20)))
    page(root, "RealtimeTotals", entries)
    go(2)
    done = {r["name"]: r["published_at"] for r in house.rows(DONE).collect()}
    assert done == dict(entries)  # published when the page says, not when the copy was made
    assert spark.read.parquet(str(tmp_path / "topics")).count() == 24 and house.state().count() == 24
