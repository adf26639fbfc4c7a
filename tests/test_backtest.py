import random
import statistics
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from peakledger.operators import series
from peakledger.plans import backtest
from tests import reference_rule as plain

HOUR = timedelta(hours=1)
POINT = "zone string, interval_start timestamp_ntz, mw double"
TRAIN, HOLDOUT = [2022, 2023], [2024]


def summer(rng, years, zone):
    """Afternoon hours of June to August, with a few hot days."""
    points = {}
    for year in years:
        for d in range(92):
            day = datetime(year, 6, 1, 5) + timedelta(days=d)
            heat = rng.choice([0, 0, 0, 500, 2500])
            for h in range(10, 22):
                if rng.random() > 0.03:
                    points[day + h * HOUR] = float(15000 + heat + 200 * (6 - abs(16 - h)) + rng.randint(-300, 300))
    return points


def tables(points):
    """Every hour's market day, base year and, per variant, the largest margin at which it is flagged (nan if none)."""
    known = plain.Series(points)
    hours = pd.DataFrame({"t": sorted(points)})
    hours["mw"] = hours["t"].map(points)
    hours["day"] = hours["t"].map(plain.market_day)
    hours["year"] = hours["day"].map(lambda d: d.year if d.month > 4 else d.year - 1)
    local = hours["t"] - plain.EST
    hours["month"], hours["he"] = local.dt.month, local.dt.hour + 1
    for variant in plain.MINUTES_AHEAD:
        bar = [known.bar(variant, t) for t in hours["t"].dt.to_pydatetime()]
        guess = [known.estimate(variant, t) for t in hours["t"].dt.to_pydatetime()]
        hours[variant] = [g / b if b is not None and g is not None else float("nan") for g, b in zip(guess, bar)]
    highest = hours.sort_values(["mw", "t"], ascending=[False, True]).drop_duplicates("day").groupby("year").head(5)
    return hours, highest.sort_values("t")


def test_walk_forward_against_thresholds_per_hour(spark, monkeypatch):
    """An hour is flagged at all margins up to its own threshold, so each score is a count of thresholds."""
    monkeypatch.setattr(backtest, "GRID", [0.9, 0.97, 1.0])
    points = summer(random.Random(4), TRAIN + HOLDOUT, "Z")
    frame = spark.createDataFrame([("Z", t, mw) for t, mw in points.items()], POINT)
    result = {k: v.collect() for k, v in backtest.walk_forward(frame, TRAIN, HOLDOUT).items()}
    hours, peaks = tables(points)
    seen = peaks[peaks["year"].isin(TRAIN)]
    w = result["window"][0]
    assert (w["months"], w["he_min"], w["he_max"]) == (sorted(set(seen["month"])), max(1, seen["he"].min() - 1), min(24, seen["he"].max() + 1))
    hours = hours[hours["month"].isin(w["months"]) & hours["he"].between(w["he_min"], w["he_max"])]
    grid = pd.DataFrame([r.asDict() for r in result["grid"]])
    assert len(grid) == 3 * 4 * 3
    for r in grid.itertuples():
        mine, top = hours[hours["year"] == r.base_year], peaks[peaks["year"] == r.base_year]
        flagged = mine[mine[r.variant] >= r.margin]
        caught = top[top["t"].isin(flagged["t"])]
        leads = [(t - plain.decided_at(r.variant, t)).total_seconds() / 3600 for t in caught["t"].dt.to_pydatetime()]
        lead = round(statistics.median(leads), 1) if leads else None
        assert (r.captured, r.alert_hours, r.alert_days, r.in_window_hours) == (len(caught), len(flagged), flagged["day"].nunique(), len(mine))
        assert lead == r.median_lead_hours or lead is None and pd.isna(r.median_lead_hours)
    chosen = {r["variant"]: r["margin"] for r in result["margins"]}
    for variant, trained in grid[grid["base_year"].isin(TRAIN)].groupby("variant"):
        front = trained.groupby("margin", as_index=False)[["captured", "alert_hours"]].sum()
        good = front[front["captured"] >= backtest.TARGET].sort_values(["alert_hours", "margin"], ascending=[True, False])
        rest = front.sort_values(["captured", "alert_hours", "margin"], ascending=[False, True, True])
        assert chosen[variant] == (good if len(good) else rest)["margin"].iloc[0]
    missed = {(r["base_year"], r["variant"], r["peak_hour"]) for r in result["missed"]}
    shown = set(hours["t"])
    expected = {(y, v, t.to_pydatetime()) for v in plain.MINUTES_AHEAD for y, t in zip(peaks["year"], peaks["t"])
                if t not in shown or not hours.loc[hours["t"] == t, v].iloc[0] >= chosen[v]}
    assert missed == expected


def test_margin_choice(spark):
    rows = [("Z", "a", 0.8, 9, 50), ("Z", "a", 0.9, 8, 40), ("Z", "a", 0.95, 8, 40), ("Z", "a", 1.0, 7, 10),   # fewest hours, largest margin
            ("Z", "b", 0.8, 5, 30), ("Z", "b", 0.9, 5, 20), ("Z", "b", 0.95, 5, 20), ("Z", "b", 1.0, 4, 1)]    # none good: first of the best
    front = spark.createDataFrame(rows, "zone string, variant string, margin double, captured bigint, alert_hours bigint")
    assert {r["variant"]: r["margin"] for r in backtest.choose_margins(front).collect()} == {"a": 0.95, "b": 0.9}


def test_tuning_is_blind_to_the_hold_out(spark):
    rng = random.Random(8)
    points = summer(rng, TRAIN + HOLDOUT, "Z")
    halved = {t: mw * 0.5 if t.year in HOLDOUT else mw for t, mw in points.items()}
    outcome = []
    for p in (points, halved):
        result = backtest.walk_forward(spark.createDataFrame([("Z", t, mw) for t, mw in p.items()], POINT), TRAIN, HOLDOUT)
        outcome.append((result["window"].collect(), sorted(result["margins"].collect())))
    assert outcome[0] == outcome[1]


def test_official_peaks_replace_derived_ones_for_their_years(spark):
    rng = random.Random(6)
    points = summer(rng, [2022, 2023], "Z")
    daily = series.daily_peaks(spark.createDataFrame([("Z", t, mw) for t, mw in points.items()], POINT))
    named = [("Z", i, datetime(2022, 7, i, 21), datetime(2022, 7, i).date()) for i in range(1, 11)]
    tracker = spark.createDataFrame(named, "zone string, rank int, interval_start timestamp_ntz, delivery_date date")
    got = backtest.truth(daily, tracker, [2022]).collect()
    assert sorted(r["peak_hour"] for r in got if r["base_year"] == 2022) == [n[2] for n in named[:5]]
    derived = backtest.truth(daily).where(F.col("base_year") == 2023).collect()
    assert sorted(r["peak_hour"] for r in got if r["base_year"] == 2023) == sorted(r["peak_hour"] for r in derived)


def test_results_are_written_and_read_back_as_live_parameters(spark, tmp_path):
    rng = random.Random(4)
    frame = spark.createDataFrame([("Z", t, mw) for t, mw in summer(rng, [2022, 2023, 2024], "Z").items()], POINT)
    result = backtest.walk_forward(frame, TRAIN, HOLDOUT)
    backtest.write_results(result, str(tmp_path / "r"))
    params = backtest.read_params(spark, str(tmp_path / "r")).collect()
    assert {p["variant"] for p in params} == {"persist2", "persist4", "day_ahead"}
    margins = {r["variant"]: r["margin"] for r in result["margins"].collect()}
    assert all(p["margin"] == margins[p["variant"]] for p in params)
