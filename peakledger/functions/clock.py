"""Time as the market counts it.

Every instant is UTC in a ``timestamp_ntz`` column, so no result depends on the session time zone.
Market time is fixed UTC-5 all year (no daylight saving), hence plain five-hour arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the rule.
LAG_MINUTES = 15                            # an hour's reading counts as public 15 minutes after the hour ends
STALENESS = {"persist2": 2, "persist4": 4}  # hours between the newest usable reading and the hour decided about
VARIANTS = ("oracle", "persist2", "persist4", "day_ahead")
LIVE_VARIANTS = ("persist2", "persist4", "day_ahead")

def _times(unit: str, n) -> Column:
    # one unit times n: make_dt_interval would do decimal arithmetic on every row
    one = F.expr(f"INTERVAL '1' {unit}")
    return one * n if isinstance(n, Column) else F.expr(f"INTERVAL '{n}' {unit}")


def hours(n) -> Column:
    """An interval of ``n`` hours; ``n`` is an int or an integer column."""
    return _times("HOUR", n)


def minutes(n) -> Column:
    return _times("MINUTE", n)


def est(start: Column) -> Column:
    return start - hours(5)


def est_day(start: Column) -> Column:
    return est(start).cast("date")


def est_midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz") + hours(5)


def hour_ending(start: Column) -> Column:
    """1..24: the hour from 16:00 to 17:00 market time is hour-ending 17."""
    return F.hour(est(start)) + 1


def hour_ending_to_utc(day: Column, he: Column) -> Column:
    """Start of the hour in UTC; null when ``he`` is not 1..24, so that a bad row shows up as null."""
    return F.when(he.between(1, 24), est_midnight(day) + hours(he.cast("int") - 1))


def base_year(day: Column) -> Column:
    """Year in which the base period (1 May to 30 April) holding ``day`` began."""
    return F.year(F.add_months(day, -4))


def base_start(day: Column) -> Column:
    return F.make_date(base_year(day), F.lit(5), F.lit(1))


def in_window(start: Column, months: Column, he_min: Column, he_max: Column) -> Column:
    return F.array_contains(months, F.month(est(start))) & hour_ending(start).between(he_min, he_max)


def decision_time(variant: Column, start: Column) -> Column:
    """When the decision about the hour beginning at ``start`` is taken."""
    out = F.when(variant == "oracle", start).when(
        variant == "day_ahead", est_midnight(est_day(start)) + minutes(LAG_MINUTES))
    for name, age in STALENESS.items():
        out = out.when(variant == name, start - hours(age - 1) + minutes(LAG_MINUTES))
    return out


def seconds_between(earlier: Column, later: Column) -> Column:
    """Exact difference as decimal seconds, whatever the session time zone."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def notice_hours(candidate: Column, decided_at: Column) -> Column:
    return F.bround(seconds_between(decided_at, candidate).cast("double") / 3600, 2)


def iso(moment: Column) -> Column:
    """ISO second in UTC. Built from the plain text form: date_format would go through the session time zone."""
    text = moment.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))


def hour_stamp(moment: Column) -> Column:
    """yyyyMMddHH."""
    number = ((F.year(moment) * 100 + F.month(moment)) * 100 + F.day(moment)) * 100 + F.hour(moment)
    return number.cast("string")


def hour_of(moment: Column) -> Column:
    """Start of the hour. date_trunc would go through the session time zone."""
    return midnight_of(moment) + hours(F.hour(moment))


def minute_of(moment: Column) -> Column:
    return midnight_of(moment) + minutes(F.hour(moment) * 60 + F.minute(moment))


def midnight_of(moment: Column) -> Column:
    return moment.cast("date").cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """Null when the text is not an ISO second in UTC."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
                  F.substring(text, 1, 19).try_cast("timestamp_ntz"))
