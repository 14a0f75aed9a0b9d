"""Time series over the tiers, at a resolution that suits the span asked for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.functions.labels import day_start, days_between, halves_between, parse_day, period_start
from gridmarts.functions.timeparse import naive, wall_clock
from gridmarts.operators.upsert import FOLDERS, read_table
from gridmarts.schemas import HOME_ZONE, WESTERN_HUB_ID

# Longest span in days per resolution.
INTRADAY_DAYS = 7
HOURLY_DAYS = 186


@dataclass(frozen=True)
class Tiers:
    """The datasets that series are read from; any may be absent."""

    rt_recent: DataFrame | None = None
    da_recent: DataFrame | None = None
    lmps: DataFrame | None = None
    lmps_daily: DataFrame | None = None
    load_daily: DataFrame | None = None
    mart_load: DataFrame | None = None


def read_tiers(spark: SparkSession, path: str) -> Tiers:
    """Tiers written under ``path`` by ``write_tiers``; those not there stay absent."""
    names = ("rt_recent", "da_recent", "lmps", "lmps_daily", "load_daily", "mart_load")
    tables = {n: read_table(spark, f"{path}/{n}", merge_schema=False) for n in names}
    return Tiers(**tables)


@dataclass(frozen=True)
class Location:
    """A hub by id, or a zone by name without that hub."""

    name: str
    hub_id: int = WESTERN_HUB_ID
    is_hub: bool = False

    def predicate(self) -> Column:
        if self.is_hub:
            return F.col("pnode_id") == self.hub_id
        return (F.col("zone") == self.name) & (F.col("pnode_id") != self.hub_id)


WESTERN_HUB = Location("WESTERN HUB", is_hub=True)
DUQ = Location(HOME_ZONE)


def grain_for(start: date, end: date) -> str:
    span = days_between(start, end)
    if span <= INTRADAY_DAYS:
        return "intraday"
    return "hourly" if span <= HOURLY_DAYS else "daily"


def _need(**tables: DataFrame | None) -> None:
    absent = [name for name, table in tables.items() if table is None]
    if absent:
        raise ValueError(f"no {' or '.join(absent)} tier for this range")


def _days(ts: Column, start: date, end: date) -> Column:
    """Whole days as bounds on the time itself, which file statistics can serve."""
    return (ts >= naive(day_start(start))) & (ts < naive(day_start(end + timedelta(days=1))))


def join_recent(rt_recent: DataFrame, da_recent: DataFrame) -> DataFrame:
    """Recent real-time prices with the day-ahead price of the same node and minute.

    Five-minute rows off the hour have no day-ahead price and keep NULL there.
    """
    time = wall_clock(F.col("datetime_beginning_ept"), strict=False).alias("ts")
    left = rt_recent.select(time, "pnode_id", "zone", "total_lmp_rt")
    right = da_recent.select(time, "pnode_id", "total_lmp_da")
    return left.join(right, ["ts", "pnode_id"], "left").select(
        "ts",
        "pnode_id",
        "zone",
        "total_lmp_da",
        "total_lmp_rt",
        (F.col("total_lmp_da") - F.col("total_lmp_rt")).alias("da_rt_spread"),
    )


def _source(
    tiers: Tiers, start: date, end: date, location: Location, grain: str
) -> tuple[DataFrame, Column, list[str]]:
    """Rows of the location and range, their time, and their price columns."""
    here = location.predicate()
    if grain == "intraday":
        _need(rt_recent=tiers.rt_recent, da_recent=tiers.da_recent)
        day_ahead = tiers.da_recent
        if location.is_hub:
            day_ahead = day_ahead.filter(here)
        # Filter before the join; the time bounds do the same for the other side.
        time = wall_clock(F.col("datetime_beginning_ept"), strict=False)
        within = _days(time, start, end)
        rows = join_recent(tiers.rt_recent.filter(here & within), day_ahead.filter(within))
        return rows, F.col("ts"), ["total_lmp_da", "total_lmp_rt", "da_rt_spread"]
    if grain == "hourly":
        _need(lmps=tiers.lmps)
        ts = F.col("hour_beginning_utc")
        rows = tiers.lmps.filter(F.col("half").isin(halves_between(start, end)))
        rows = rows.filter(_days(ts, start, end) & here)
        return rows, ts, ["total_lmp_da", "total_lmp_rt", "da_rt_spread"]
    _need(lmps_daily=tiers.lmps_daily)
    day = F.col("date_utc")
    rows = tiers.lmps_daily.filter(day.between(F.lit(start), F.lit(end)) & here)
    return rows, day.cast("timestamp_ntz"), ["avg_lmp_da", "avg_lmp_rt", "avg_spread"]


def lmp_series(
    tiers: Tiers,
    start: str | date,
    end: str | date,
    location: Location,
    limit: int | None = None,
    mean: Callable[[Column], Column] = F.avg,
    grain: str | None = None,
) -> DataFrame:
    """(ts, da, rt, spread): the mean price per time over the nodes of the location.

    ``limit`` is for a display that wants the first so many times; figures are made of
    the whole series. ``grain`` overrides the resolution that the span suggests.
    """
    start, end = parse_day(start), parse_day(end)
    rows, ts, (da, rt, spread) = _source(tiers, start, end, location, grain or grain_for(start, end))
    prices = rows.select(
        ts.alias("ts"),
        F.col(da).cast("double").alias("da"),
        F.col(rt).cast("double").alias("rt"),
        F.col(spread).cast("double").alias("spread"),
    )
    means = [mean(F.col(c)).alias(c) for c in ("da", "rt", "spread")]
    return _first(prices.groupBy("ts").agg(*means).orderBy(F.col("ts").asc_nulls_last()), limit)


def recent_from(rt_recent: DataFrame) -> date | None:
    """The first local day that the recent tier has whole: the day after its earliest time."""
    time = wall_clock(F.col("datetime_beginning_ept"), strict=False)
    return rt_recent.agg(F.date_add(F.to_date(F.min(time)), 1)).first()[0]


def pieces(
    tiers: Tiers, start: date, end: date, first_recent: date | None = None
) -> list[tuple[str, date, date]]:
    """Which tier serves which days: the finest that suits the span, else the next that is there.

    A span of days that goes back beyond the recent tier is cut at its first whole day; what lies before comes from the half-years,
    as does a long span without a daily tier. Without half-years hourly spans come from the daily tier. ``first_recent`` is that
    first day, which whoever wrote the tier knows; by default it is taken from the tier's times.
    """
    grain = grain_for(start, end)
    if grain == "intraday":
        there = tiers.rt_recent is not None and tiers.da_recent is not None
        first = (first_recent or recent_from(tiers.rt_recent)) if there else None
        if first is not None and first <= start:
            return [("intraday", start, end)]
        if first is not None and first <= end:
            return [*_stored(tiers, "hourly", start, first - timedelta(days=1)), ("intraday", first, end)]
        grain = "hourly"
    return _stored(tiers, grain, start, end)


def _stored(tiers: Tiers, grain: str, start: date, end: date) -> list[tuple[str, date, date]]:
    other = {"hourly": "daily", "daily": "hourly"}[grain]
    table = {"hourly": tiers.lmps, "daily": tiers.lmps_daily}
    return [(other if table[grain] is None and table[other] is not None else grain, start, end)]


def lmp_series_by_pieces(
    tiers: Tiers,
    start: str | date,
    end: str | date,
    location: Location,
    mean: Callable[[Column], Column] = F.avg,
    first_recent: date | None = None,
) -> DataFrame:
    """(ts, da, rt, spread, grain) over a range of which no single tier has all.

    Days are those of the tier that serves them: local ones intraday, UTC ones else, as are the times.
    """
    found = [
        lmp_series(tiers, first, last, location, mean=mean, grain=grain).withColumn("grain", F.lit(grain))
        for grain, first, last in pieces(tiers, parse_day(start), parse_day(end), first_recent)
    ]
    return reduce(DataFrame.unionByName, found).orderBy(F.col("ts").asc_nulls_last())


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    return ordered if limit is None else ordered.limit(limit)


def _folders(rows: DataFrame, start: date, end: date) -> DataFrame:
    """Skip whole folders of a table laid out by UTC day or month."""
    for unit, folder in FOLDERS.items():
        if folder in rows.columns:
            first, last = (period_start(F.lit(day), unit) for day in (start, end))
            rows = rows.filter(F.col(folder).between(first, last))
    return rows


def load_series(
    tiers: Tiers,
    start: str | date,
    end: str | date,
    zone: str = HOME_ZONE,
    limit: int | None = None,
) -> DataFrame:
    """(ts, actual, forecast, peak): hourly for spans up to the hourly limit, else daily."""
    start, end = parse_day(start), parse_day(end)
    if grain_for(start, end) == "daily":
        _need(load_daily=tiers.load_daily)
        rows = tiers.load_daily.filter(F.col("date_utc").between(F.lit(start), F.lit(end)))
        ts, columns = F.col("date_utc").cast("timestamp_ntz"), ("avg_load_mw", "avg_forecast_mw", "peak_load_mw")
    else:
        _need(mart_load=tiers.mart_load)
        ts, columns = F.col("hour_beginning_utc"), ("actual_load_mw", "forecast_load_mw", "actual_load_mw")
        rows = _folders(tiers.mart_load, start, end).filter(_days(ts, start, end))
    values = [F.col(c).cast("double").alias(n) for c, n in zip(columns, ("actual", "forecast", "peak"))]
    # The value columns make the cut at `limit` definite where a time occurs twice.
    order = [F.col(c).asc_nulls_last() for c in ("ts", "actual", "forecast", "peak")]
    return _first(rows.filter(F.col("zone") == zone).select(ts.alias("ts"), *values).orderBy(*order), limit)
