"""Which arriving events the live evaluator acts on, and what it then writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.functions import clock
from peakledger.operators import rule

RECENT_HOURS = 3  # fixed value: an older live hour is history, so a replay announces nothing again


def recent_live(events: DataFrame, now: Column, hours: int = RECENT_HOURS) -> DataFrame:
    """Live events ingested at most ``hours`` ago; exactly on the limit still counts."""
    return events.where((F.col("reason") == "live") & (F.col("ingested_at") >= now - clock.hours(hours)))


def evaluate(newest: DataFrame, points: DataFrame, params: DataFrame, evaluated_at: Column) -> DataFrame:
    """Signal rows for hours that have just become public, off-season ones included.

    ``newest``: zone, interval_start. ``points``: the history, versions resolved. ``params``: zone, variant, margin, months,
    he_min, he_max. The decision is the backtest's own function.
    """
    window = params.select("zone", "months", "he_min", "he_max").distinct()
    margins = params.select("zone", "variant", "margin")
    candidates = rule.live_candidates(newest.select("zone", "interval_start").distinct().join(window, "zone")).join(
        margins, ["zone", "variant"])
    return rule.signal_rows(rule.decide(candidates, points), evaluated_at)
