"""Joined facts and their incremental refresh."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.operators.upsert import high_water, newer_than, read_table, upsert_table, write_history
from gridmarts.plans import staging
from gridmarts.schemas import MART_LMPS_KEY, MART_LOAD_KEY
from gridmarts.sources.feeds import prune_folders

HOUR = "hour_beginning_utc"

_PRICES = ("energy_price", "congestion_price", "loss_price", "total_lmp")


def build_mart_lmps(da: DataFrame, rt: DataFrame) -> DataFrame:
    """Day-ahead prices with the real-time prices of the same node and hour."""
    da_prices, rt_prices = ([f"{p}_{s}" for p in _PRICES] for s in ("da", "rt"))
    keys = ["pnode_id", "hour_beginning_utc"]
    left = da.select(*keys, "hour_beginning_ept", "pnode_name", "pnode_type", "zone", *da_prices)
    joined = left.join(rt.select(*keys, *rt_prices), keys, "left")
    return joined.select(
        "hour_beginning_utc",
        "hour_beginning_ept",
        "pnode_id",
        "pnode_name",
        "pnode_type",
        "zone",
        *da_prices,
        *rt_prices,
        (F.col("total_lmp_da") - F.col("total_lmp_rt")).alias("da_rt_spread"),
    )


def error_pct_of_forecast(actual: str, forecast: str):
    """Signed error in percent of the forecast; NULL for a forecast of zero."""
    miss, base = F.col(actual) - F.col(forecast), F.col(forecast)
    return F.when(base != 0, miss / base * 100.0)


def build_mart_load(load: DataFrame, forecast: DataFrame) -> DataFrame:
    """Metered load with the forecast for the same zone and hour, letter case ignored."""
    keys = ["zone_key", "hour_beginning_utc"]
    left = load.select(
        F.upper("zone").alias("zone_key"),
        "hour_beginning_utc",
        "hour_beginning_ept",
        "zone",
        "load_area",
        F.col("load_mw").alias("actual_load_mw"),
        "is_verified",
    )
    right = forecast.select(
        F.upper("forecast_area").alias("zone_key"),
        F.col("forecast_hour_utc").alias("hour_beginning_utc"),
        "forecast_load_mw",
    )
    # Staging has left one forecast per area and hour.
    return left.join(right, keys, "left").select(
        "hour_beginning_utc",
        "hour_beginning_ept",
        "zone",
        "load_area",
        "actual_load_mw",
        "is_verified",
        "forecast_load_mw",
        (F.col("actual_load_mw") - F.col("forecast_load_mw")).alias("forecast_error_mw"),
        error_pct_of_forecast("actual_load_mw", "forecast_load_mw").alias("forecast_error_pct"),
    )


def _new_feed(
    feed: DataFrame, stored: DataFrame, stage: Callable[[DataFrame], DataFrame], time_col: str, lookback_hours: int
) -> DataFrame:
    """Staged rows after the newest stored hour. Older folders of the feed are not opened.

    Folders are local days or months and the stored hours UTC, so a day more is read; the
    exact cut is made on the staged times.
    """
    newest = feed.sparkSession.range(1).select(high_water(stored, HOUR).alias("newest")).first()["newest"]
    if newest is not None:
        day = (newest - timedelta(hours=lookback_hours, days=1)).date()
        feed = prune_folders(feed, F.lit(day))
    return newer_than(stage(feed), stored, time_col, target_time_col=HOUR, lookback_hours=lookback_hours)


def refresh_mart_lmps(
    spark: SparkSession,
    path: str,
    da_feed: DataFrame,
    rt_feed: DataFrame,
    lookback_hours: int = 0,
    unit: str = "day",
    stage_da: Callable[[DataFrame], DataFrame] = staging.stage_da,
    stage_rt: Callable[[DataFrame], DataFrame] = staging.stage_rt,
) -> None:
    """Add the hours after the newest stored one, on both sides of the join, from landed feeds."""
    stored = read_table(spark, path, merge_schema=False)  # only its hours are read
    if stored is None:
        rows = build_mart_lmps(stage_da(da_feed), stage_rt(rt_feed))
        write_history(path, rows, MART_LMPS_KEY, HOUR, unit)
        return
    da = _new_feed(da_feed, stored, stage_da, HOUR, lookback_hours)
    rt = _new_feed(rt_feed, stored, stage_rt, HOUR, lookback_hours)
    upsert_table(spark, path, build_mart_lmps(da, rt), MART_LMPS_KEY, HOUR, unit)


def refresh_mart_load(
    spark: SparkSession,
    path: str,
    load_feed: DataFrame,
    forecast_feed: DataFrame,
    lookback_hours: int = 0,
    unit: str = "day",
    stage_load: Callable[[DataFrame], DataFrame] = staging.stage_load,
    stage_forecast: Callable[[DataFrame], DataFrame] = staging.stage_forecast,
) -> None:
    """The same for load. The forecast is cut by the hour it is for, and laid out by it."""
    stored = read_table(spark, path, merge_schema=False)  # only its hours are read
    if stored is None:
        rows = build_mart_load(stage_load(load_feed), stage_forecast(forecast_feed))
        write_history(path, rows, MART_LOAD_KEY, HOUR, unit)
        return
    load = _new_feed(load_feed, stored, stage_load, HOUR, lookback_hours)
    forecast = _new_feed(forecast_feed, stored, stage_forecast, "forecast_hour_utc", lookback_hours)
    upsert_table(spark, path, build_mart_load(load, forecast), MART_LOAD_KEY, HOUR, unit)
