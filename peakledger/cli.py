"""Command line: python -m peakledger.cli <command> ...   (or spark-submit)

Folders: --files root/<report>/<file>, --topics, --house (the tables), --checkpoint. Times are ISO in UTC.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.operators import merge, metrics, quality
from peakledger.plans import backtest, ingest, reconciliation, replay
from peakledger.sources import files
from peakledger.streaming import consumer, counters, evaluator, producer
from peakledger.streaming.evaluator import utc_now
from peakledger.streaming.warehouse import CURRENT, RAW, SIGNALS, Warehouse

LATEST = 12  # fixed value: signals shown by `signals`


def show(rows: DataFrame) -> list[dict]:
    out = [r.asDict() for r in rows.collect()]  # reports of a few rows
    for r in out:
        print(json.dumps(r, default=str))
    return out


def produce(spark, a):
    """Send what is new in the files. --always keeps following the folder, or with --pages the index pages in it."""
    house = Warehouse(spark, a.house)
    if a.always or a.pages:
        producer.run(spark, a.files, house, a.topics, a.checkpoint, a.mode, always=a.always, metrics=a.metrics,
                     listing={} if a.pages else None).awaitTermination()
        return 0
    now = utc_now()
    out = ingest.run(files.list_files(spark, a.files), house, a.topics, a.mode, now, f"{a.mode}-{now:%Y%m%dT%H%M%S%f}", metrics=a.metrics)
    print(json.dumps({"events_produced": out["events_produced"], "events_deduplicated": out["events_deduplicated"],
                      **{f"{report}.{outcome}": n for (report, outcome), n in sorted(out["files"].items())}}))
    return 0


def consume(spark, a):
    query = consumer.run(spark, a.topics, Warehouse(spark, a.house), a.checkpoint, a.quarantine, a.name, live=a.always,
                         files_per_batch=a.files_per_batch, metrics=a.metrics)
    query.awaitTermination()


def health(spark, a):
    """Counters of all jobs, and the age, speed and batch times of each."""
    counted = counters.rows(spark, a.metrics)
    show(counters.totals(counted).orderBy("source", "report"))
    show(counters.health(counted, F.lit(utc_now()).cast("timestamp_ntz")).orderBy("source"))


def check(spark, a):
    """The quality suite; violations make the command fail."""
    house = Warehouse(spark, a.house)
    rows = show(quality.report(house.raw(), house.current()))
    return 1 if any(r["violations"] for r in rows) else 0


def summary(spark, a):
    house = Warehouse(spark, a.house)
    for name, table in ((RAW, house.raw()), (CURRENT, house.current())):
        show(merge.checksum(table).select(F.lit(name).alias("table_name"), "n", "checksum"))


def runs(spark, a):
    show(Warehouse(spark, a.house).runs().orderBy("run_key"))


def signals(spark, a):
    rows = Warehouse(spark, a.house).rows(SIGNALS).orderBy(F.desc("evaluated_at"), "candidate_hour", "zone", "variant").limit(LATEST)
    show(rows)


def reset(spark, a):
    Warehouse(spark, a.house).truncate()


def reconcile(spark, a):
    house, end = Warehouse(spark, a.house), datetime.fromisoformat(a.end)
    out = reconciliation.run(spark, files.list_files(spark, a.files), house, a.topics, datetime.fromisoformat(a.start), end, utc_now(),
                             deliver=lambda: consumer.run(spark, a.topics, house, a.checkpoint, a.quarantine, a.name).awaitTermination())
    print(json.dumps({**out["run"], "quality": out["quality"]}, default=str))
    if out["failure"] is not None:
        raise out["failure"]
    return 1 if any(out["quality"].values()) else 0


def seed(spark, a):
    reconciliation.seed(Warehouse(spark, a.house), a.cutoff, files.list_files(spark, a.files))


def archive(spark, a):
    held = spark.read.schema("report string, name string").parquet(a.archive) if a.append else spark.createDataFrame([], "report string, name string")
    files.archive(files.list_files(spark, a.files), held, a.archive)


def run_backtest(spark, a):
    years = lambda text: [int(y) for y in text.split(",") if y]
    points, tracker = backtest.load(spark, a.files)
    official = years(a.official)
    result = backtest.walk_forward(points.persist(), years(a.train), years(a.holdout), tracker=tracker if official else None,
                                   official_years=official or None)
    backtest.write_results(result, a.results)
    show(spark.read.parquet(f"{a.results}/totals").orderBy("zone", "variant"))


def run_replay(spark, a):
    points, _ = backtest.load(spark, a.files)
    params = backtest.read_params(spark, a.results)
    days = points.select("zone").distinct().withColumn("day", F.lit(date.fromisoformat(a.day)))
    margins = params.groupBy("zone").agg(F.map_from_entries(F.collect_list(F.struct("variant", "margin"))).alias("margins"),
                                         F.first("months").alias("months"), F.first("he_min").alias("he_min"), F.first("he_max").alias("he_max"))
    newest = points.select("zone", "interval_start").join(margins, "zone")
    show(replay.replay(points, newest, days).select("variant", "decided_at", "candidate_hour", "estimate", "bar").orderBy("decided_at", "candidate_hour"))


def evaluate(spark, a):
    evaluator.run(spark, a.topics, Warehouse(spark, a.house), backtest.read_params(spark, a.results), a.checkpoint, a.out,
                  always=a.always).awaitTermination()


def loadtest(spark, a):
    show(metrics.drain_summary(files.load_samples(spark, a.samples)))


COMMANDS = {
    "produce": (produce, ["files", "house", "topics"]), "consume": (consume, ["topics", "house", "checkpoint", "quarantine"]),
    "health": (health, ["metrics"]), "check": (check, ["house"]), "summary": (summary, ["house"]), "runs": (runs, ["house"]), "signals": (signals, ["house"]),
    "reset": (reset, ["house"]), "seed": (seed, ["files", "house", "cutoff"]),
    "reconcile": (reconcile, ["files", "house", "topics", "checkpoint", "quarantine", "start", "end"]), "archive": (archive, ["files", "archive"]),
    "backtest": (run_backtest, ["files", "results"]), "replay": (run_replay, ["files", "results", "day"]),
    "evaluate": (evaluate, ["topics", "house", "results", "checkpoint", "out"]), "loadtest": (loadtest, ["samples"]),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="peakledger")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (fn, needed) in COMMANDS.items():
        sub = commands.add_parser(name, help=(fn.__doc__ or "").split("\n")[0])
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        for option, default in (("mode", "live"), ("checkpoint", None), ("name", "demand"), ("metrics", None), ("train", "2022,2023"),
                                ("holdout", "2024,2025"), ("official", "")):
            if option not in needed:
                sub.add_argument(f"--{option}", default=default)
        sub.add_argument("--files-per-batch", type=int)
        sub.add_argument("--always", action="store_true")
        sub.add_argument("--append", action="store_true")
        sub.add_argument("--pages", action="store_true")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"peakledger-{args.command}").getOrCreate()
    return COMMANDS[args.command][0](spark, args) or 0


if __name__ == "__main__":
    raise SystemExit(main())
