"""Tables of a topic out of one shuffle, against plain merges of every row."""

import hashlib
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from peakledger.functions.events import CURRENT_KEY, RAW_KEY
from peakledger.operators import difference, merge
from peakledger.operators.merge import Held
from peakledger.plans.catalog import tables

ROW = ("report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double, published_at timestamp_ntz, "
       "ingested_at timestamp_ntz, source_uri string, reason string")
T = datetime(1997, 12, 31, 12)
EARLY, WHOLE = "ingested_at < TIMESTAMP_NTZ '1998-01-01'", "reason <> 'lost'"


def rows(seed=1, n=600):
    pick = random.Random(seed)
    some = lambda v: None if pick.random() < 0.06 else v
    out = [(some(pick.choice("RP")), some(T + timedelta(hours=pick.randrange(6))), some("A"), some(pick.randrange(4)), some(float(pick.randrange(3))),
            some(T), some(T + timedelta(hours=pick.randrange(24))), some(f"raw/{pick.randrange(3)}"), pick.choice(["live", "lost", None])) for _ in range(n)]
    return out + out[:40]


def shown(df):
    """Rows without the reason, which decides no merge: rows that are alike but for it may stand for each other."""
    return sorted(map(str, (tuple(r) for r in df.drop("reason").select(*[c.split()[0] for c in ROW.split(", ")][:-1]).collect())))


def expected(spark):
    """table, rows: by the merges as they are without ``held``."""
    first = lambda df: merge.best(df, RAW_KEY, merge.FIRST_SEEN)
    latest = lambda df: merge.best(df, CURRENT_KEY, merge.LAST_SEEN)
    feed = spark.createDataFrame(rows(), ROW)
    one, two, short = feed.where(EARLY), feed.where(f"NOT ({EARLY})"), feed.where(WHOLE)
    return {"raw": first(feed), "current": latest(feed), "raw_short": first(short), "current_short": latest(short),
            "raw_built": merge.merge_raw(first(one), two), "current_built": merge.merge_current(latest(one), two)}


TABLES = {"raw": merge.first_held, "current": merge.latest_held, "raw_short": lambda: merge.first_held(F.expr(WHOLE)),
          "current_short": lambda: merge.latest_held(F.expr(WHOLE)), "raw_built": lambda: merge.raw_merged(F.expr(EARLY)), "current_built": lambda: merge.current_merged(F.expr(EARLY))}


@pytest.mark.parametrize("full", [None, 0, 60])
def test_held_rows_are_those_of_the_merges(spark, full):
    """With nulls and copies; no bucket, each bucket and some buckets cut down before the shuffle."""
    kept = merge.held(spark.createDataFrame(rows(), ROW).repartition(5), {n: t() for n, t in TABLES.items()}, full)
    for name, table in expected(spark).items():
        assert shown(kept.where(name).drop(*TABLES)) == shown(table), name


@pytest.mark.parametrize("name", ["merge_current", "merge_raw_versions"])
def test_no_map_task_of_a_merge_sorts(spark, name):
    """Sorting a map task spills it; only intervals with very many rows are cut down before they meet."""
    feed = spark.createDataFrame(rows(), ROW)
    out = {"merge_current": merge.latest_versions, "merge_raw_versions": merge.first_versions}[name](feed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    cold = plan[plan.index("REPARTITION_BY_COL"):plan.index("LeftSemi")]  # below the last shuffle, down to the full buckets
    assert "WindowGroupLimit" not in cold.split("Exchange hashpartitioning")[0] and "LeftAnti" in cold.split("Exchange hashpartitioning")[0]


def lineitem(spark, folder):
    pick = random.Random(3)
    day = datetime(1997, 11, 1)
    data = [(pick.randrange(3000), pick.randrange(50), pick.randrange(80), 1 + pick.randrange(7), 1.0, float(pick.randrange(2000)), 0.0, 0.0,
             pick.choice("ANR"), "O", day + timedelta(days=pick.randrange(120))) for _ in range(3000)]
    spark.createDataFrame(data, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_replay_shuffles_the_topic_once(spark, tmp_path):
    """Both merges, both rebuilds of both topics and the comparisons share one shuffle (and one of full buckets)."""
    out = entry.queries()["replay_equivalence"](spark, lineitem(spark, tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(interval_start") == 2
    got = {r["table_name"]: (r["n_rows"], r["differing"]) for r in out.collect()}
    whole, lost = [[v for k, v in got.items() if ("lost" in k) == at] for at in (False, True)]
    assert all(n > 0 and d == 0 for n, d in whole) and all(n > 0 and d > 0 for n, d in lost)


@pytest.mark.parametrize("name, label", [("differing_rows", "/compared-"), ("difference_levels", "/compared-"), ("quality_report", "/kept-")])
def test_tables_of_a_topic_are_stored_once(spark, tmp_path, name, label):
    """All tables that a query compares or checks come out of one pass and lie in one folder."""
    out = entry.queries()[name](spark, lineitem(spark, tmp_path))
    folders = {f.rsplit("/", 1)[0] for f in out.inputFiles() if "/buckets-" not in f}
    assert len(folders) == 1 and label in folders.pop()
    assert out.count() > 0


def test_levels_carry_a_hash_in_place_of_the_texts(spark, tmp_path):
    """Sums need no more of a row than its hash, so digests are neither shuffled nor stored; the levels are those of whole rows."""
    sf = lineitem(spark, tmp_path)
    out = entry.queries()["difference_levels"](spark, sf)
    kept = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
    assert "row" in kept.columns and not {"content_sha256", "source_uri", "value_mw"} & set(kept.columns)
    expected = []
    for name, (left, right) in tables.stored_pairs(spark, sf, tables.COLUMNS).items():
        both = left.unionByName(right).select(*difference.BUCKET).distinct().collect()
        off = left.exceptAll(right).unionByName(right.exceptAll(left)).select(*difference.BUCKET).distinct().collect()
        expected += [(name, level, *[len({tuple(r)[:n] for r in found}) for found in (both, off)]) for n, level in enumerate(["report", "zone", "day"], 1)]
    assert sorted(map(tuple, out.collect())) == sorted(expected) and all(0 < e[3] <= e[2] for e in expected)


@pytest.mark.parametrize("full", [None, 0])
def test_digests_travel_as_bytes_and_come_back_as_they_were(spark, full):
    """Any text, whether its digits are hex, whole or in lower case; tables may still choose among rows by it."""
    texts = [hashlib.sha256(b"1").hexdigest(), hashlib.sha256(b"2").hexdigest().upper(), "abc", "0", "", "no digest", "é", " ab", "ab\n", None]
    feed = spark.createDataFrame([(*r, texts[i % 10]) for i, r in enumerate(rows())], f"{ROW}, content_sha256 string").repartition(5)
    tables = {"each": Held([*RAW_KEY, "content_sha256"], [F.col("content_sha256").asc()], F.lit(True)),
              "some": Held([*RAW_KEY, "content_sha256"], [F.col("content_sha256").asc()], F.col("content_sha256").isin(*texts[:3]))}
    out = merge.held(feed, tables, full)
    kept = [tuple(r) for r in out.where("each").select(*RAW_KEY, "content_sha256").collect()]
    assert out.columns == [*feed.columns, *tables] and set(kept) == {tuple(r) for r in feed.select(*RAW_KEY, "content_sha256").collect()}
    assert len(kept) == len(set(kept)) and {r["content_sha256"] for r in out.where("some").collect()} == set(texts[:3])


def test_merged_rows_are_shuffled_with_their_digest_as_bytes(spark, tmp_path):
    out = entry.queries()["merge_raw_versions"](spark, lineitem(spark, tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("REPARTITION_BY_COL"):]
    assert "unhex(" in below and "unhex(" not in plan[:plan.index("REPARTITION_BY_COL")]
    assert all(len(r["content_sha256"]) == 64 for r in out.collect())


@pytest.mark.parametrize("partitions, dealt", [(4, "4"), (600, "200"), (1001, "1001")])
def test_no_map_task_sorts_for_the_number_of_partitions(spark, partitions, dealt):
    """Above 200 partitions Spark sorts what a map task writes, and spills it; far above, fewer would be too large to sort after it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        feed = spark.createDataFrame(rows(), ROW)
        out = merge.first_versions(feed)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"hashpartitioning\(interval_start\S*, report\S*, zone\S*, (\d+)\), REPARTITION", plan) == [dealt]
        if partitions == 600:
            assert shown(out) == shown(merge.best(feed, RAW_KEY, merge.FIRST_SEEN))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
