"""Small labels and date windows."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_year(ts: Column) -> Column:
    """'2024H1' for January to June, '2024H2' for the rest."""
    return F.concat(F.year(ts).cast("string"), F.when(F.month(ts) <= 6, "H1").otherwise("H2"))


def halves_between(start: date, end: date) -> list[str]:
    """Every half-year label that the closed range touches."""
    first = start.year * 2 + (start.month > 6)
    last = end.year * 2 + (end.month > 6)
    return [f"{n // 2}H{n % 2 + 1}" for n in range(first, last + 1)]


def spread_sign(spread: Column) -> Column:
    return F.when(spread >= 0, "pos").when(spread < 0, "neg").otherwise("na")


def period_start(ts: Column, unit: str) -> Column:
    """First day of the day or month that ``ts`` falls in."""
    day = F.to_date(ts)
    return F.trunc(day, "month") if unit == "month" else day


def utc_date(ts: Column, day_zone: str = "UTC") -> Column:
    """Calendar day of a UTC time, cut in ``day_zone``."""
    if day_zone != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(day_zone), ts)
    return F.to_date(ts)


def parse_day(value: str | date, today: date | None = None) -> date:
    """A date, an ISO text, or the words 'today' and 'yesterday'."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    words = {"today": 0, "yesterday": 1}
    if value.lower() in words:
        return (today or date.today()) - timedelta(days=words[value.lower()])
    return date.fromisoformat(value)


def days_between(start: date, end: date) -> int:
    return (end - start).days


def day_start(day: date) -> datetime:
    return datetime.combine(day, time.min)
