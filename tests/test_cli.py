import json
import random
from datetime import date, timedelta

from peakledger import cli
from tests import samples


def lines(capsys):
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_produce_consume_summary_reset(spark, tmp_path, capsys):
    day = date(2026, 9, 28)
    samples.write(tmp_path / "files", "RealtimeTotals", "PUB_RealtimeTotals_2026092808_v12.xml", samples.realtime(day, 8, [16000.0 + i for i in range(12)]))
    samples.write(tmp_path / "files", "ICIDemand", "PUB_ICIDemand_2026_v1.csv", samples.ici_demand(day, 1))
    where = {k: str(tmp_path / k) for k in ("files", "house", "topics", "checkpoint", "quarantine")}
    go = lambda command, *keys: cli.main([command, *[x for k in keys for x in (f"--{k}", where[k])]], spark)
    assert go("produce", "files", "house", "topics") == 0
    assert lines(capsys)[0]["events_produced"] == 36
    go("consume", "topics", "house", "checkpoint", "quarantine")
    go("summary", "house")
    assert [(r["table_name"], r["n"]) for r in lines(capsys)] == [("raw_demand_versions", 36), ("current_demand", 36)]
    assert go("check", "house") == 0 and len(lines(capsys)) == 4
    go("reset", "house")
    go("summary", "house")
    assert [r["n"] for r in lines(capsys)] == [0, 0]


def test_backtest_and_replay_from_files(spark, tmp_path, capsys):
    rng = random.Random(5)
    for year in (2022, 2023, 2024):
        heat = {d: rng.choice([0, 0, 0, 3000]) for d in range(120)}
        text = samples.ici_demand(date(year, 5, 1), 120, lambda d, h: 15000 + heat[d] + 300 * (8 - abs(17 - h)) + rng.randint(-50, 50))
        samples.write(tmp_path / "files", "ICIDemand", f"PUB_ICIDemand_{year}.csv", text)
    peaks = [(date(2022, 5, 1) + timedelta(days=40 + i), 17, 30000.0 - i) for i in range(6)]
    samples.write(tmp_path / "files", "ICIPeakTracker", "PUB_ICIPeakTracker_2022.xml", samples.tracker(peaks))
    files, results = str(tmp_path / "files"), str(tmp_path / "results")
    cli.main(["backtest", "--files", files, "--results", results, "--train", "2022,2023", "--holdout", "2024", "--official", "2022"], spark)
    totals = lines(capsys)
    assert {t["variant"] for t in totals} == {"oracle", "persist2", "persist4", "day_ahead"} and all(t["peaks"] == 5 for t in totals)
    cli.main(["replay", "--files", files, "--results", results, "--day", "2024-07-20"], spark)
    assert all(r["estimate"] >= 0.8 * r["bar"] for r in lines(capsys))
    (tmp_path / "loads").mkdir()
    (tmp_path / "loads" / "run.csv").write_text("elapsed_s,replicas,lag\n0,1,730\n14,2,315\n33,1,0\n")
    cli.main(["loadtest", "--samples", str(tmp_path / "loads")], spark)
    assert lines(capsys)[0]["drain_seconds"] == 33
