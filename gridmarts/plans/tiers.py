"""Extracts by resolution: recent days, half-years, daily."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts.functions.casts import lenient_int, to_real
from gridmarts.functions.labels import half_year, period_start, utc_date
from gridmarts.functions.timeparse import naive, us_wall_clock
from gridmarts.sources.feeds import prune_folders
from gridmarts.sources.sinks import write_partitioned, write_table

TIME = "datetime_beginning_ept"


def recent(df: DataFrame, time_col: str, as_of: datetime | Column, days: int = 7) -> DataFrame:
    """Rows whose US-style time lies at most ``days`` before ``as_of`` (a naive time)."""
    now = as_of if isinstance(as_of, Column) else naive(as_of)
    first = now - F.make_dt_interval(days=F.lit(days))
    rows = prune_folders(df, F.to_date(first))
    return rows.filter(us_wall_clock(F.col(time_col)) >= first)


def _zone_or_name() -> Column:
    return F.coalesce(F.trim("zone"), F.trim("pnode_name")).alias("zone")


def recent_rt(feed: DataFrame, as_of: datetime | Column, days: int = 7) -> DataFrame:
    """Recent real-time prices, five-minute or hourly as the feed has them."""
    return recent(feed, TIME, as_of, days).select(
        TIME,
        lenient_int(feed, "pnode_id").alias("pnode_id"),
        F.trim("pnode_name").alias("pnode_name"),
        _zone_or_name(),
        to_real(F.col("total_lmp_rt")).alias("total_lmp_rt"),
        to_real(F.col("congestion_price_rt")).alias("congestion_rt"),
        to_real(F.col("marginal_loss_price_rt")).alias("loss_rt"),
    )


def recent_da(feed: DataFrame, as_of: datetime | Column, days: int = 7) -> DataFrame:
    """Recent day-ahead prices."""
    return recent(feed, TIME, as_of, days).select(
        TIME,
        lenient_int(feed, "pnode_id").alias("pnode_id"),
        F.trim("pnode_name").alias("pnode_name"),
        _zone_or_name(),
        to_real(F.col("total_lmp_da")).alias("total_lmp_da"),
    )


def half_year_tier(mart: DataFrame) -> DataFrame:
    """Hourly prices at reduced precision, labelled with their half-year."""
    hour = F.col("hour_beginning_utc")
    return mart.filter(hour.isNotNull()).select(
        hour,
        "pnode_id",
        "pnode_name",
        "zone",
        *[to_real(F.col(c)).alias(c) for c in ("total_lmp_da", "total_lmp_rt", "da_rt_spread")],
        half_year(hour).alias("half"),
    )


def write_half_years(mart: DataFrame, path: str) -> None:
    """One folder per half-year, written in one pass over the fact."""
    tier = half_year_tier(mart)
    write_partitioned(tier, path, "half", sort_cols=["pnode_id", "hour_beginning_utc"])


def history_extent(mart: DataFrame) -> DataFrame:
    """First and last UTC day of the fact."""
    hour = "hour_beginning_utc"
    return mart.agg(
        F.to_date(F.min(hour)).alias("min_date"), F.to_date(F.max(hour)).alias("max_date")
    )


def lmp_daily(
    mart: DataFrame, day_zone: str = "UTC", mean: Callable[[Column], Column] = F.avg
) -> DataFrame:
    """Prices per day and node."""
    day = utc_date(F.col("hour_beginning_utc"), day_zone).alias("date_utc")
    return mart.groupBy(day, "pnode_id", "pnode_name", "zone").agg(
        to_real(mean(F.col("total_lmp_da"))).alias("avg_lmp_da"),
        to_real(mean(F.col("total_lmp_rt"))).alias("avg_lmp_rt"),
        to_real(F.min("total_lmp_da")).alias("min_lmp_da"),
        to_real(F.max("total_lmp_da")).alias("max_lmp_da"),
        to_real(mean(F.col("da_rt_spread"))).alias("avg_spread"),
        F.count("*").alias("hours"),
    )


def load_daily(
    mart: DataFrame, day_zone: str = "UTC", mean: Callable[[Column], Column] = F.avg
) -> DataFrame:
    """Load and forecast per day and zone; the error is the mean of its absolute percentage."""
    day = utc_date(F.col("hour_beginning_utc"), day_zone).alias("date_utc")
    return mart.groupBy(day, "zone").agg(
        to_real(mean(F.col("actual_load_mw"))).alias("avg_load_mw"),
        to_real(F.max("actual_load_mw")).alias("peak_load_mw"),
        to_real(mean(F.col("forecast_load_mw"))).alias("avg_forecast_mw"),
        to_real(mean(F.abs("forecast_error_pct"))).alias("avg_forecast_err_pct"),
    )


def write_tiers(
    path: str,
    dims: dict[str, DataFrame] | None = None,
    recent_tables: dict[str, DataFrame] | None = None,
    mart_lmps: DataFrame | None = None,
    mart_load: DataFrame | None = None,
) -> None:
    """Write whichever tiers there is input for, each to its own folder under ``path``."""
    for name, table in {**(dims or {}), **(recent_tables or {})}.items():
        write_table(table, f"{path}/{name}")
    if mart_lmps is not None:
        write_half_years(mart_lmps, f"{path}/lmps")
        write_table(lmp_daily(mart_lmps).orderBy("date_utc", "pnode_id"), f"{path}/lmps_daily")
    if mart_load is not None:
        write_table(load_daily(mart_load).orderBy("date_utc", "zone"), f"{path}/load_daily")
        by_month = mart_load.drop("month_utc").withColumn("month_utc", period_start(F.col("hour_beginning_utc"), "month"))
        write_partitioned(by_month, f"{path}/mart_load", "month_utc", ["zone", "hour_beginning_utc"])
