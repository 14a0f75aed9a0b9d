"""Landed feeds to typed relations.

``iso_zone`` is the zone of ISO texts without an offset. The default, UTC, is how such
rows have been read so far; pass the market zone to treat them as local time like the
other rows. With ``strict`` an unreadable time stops the job; without it, it is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmarts.functions.casts import lenient_int, to_bool, to_double
from gridmarts.functions.timeparse import to_utc, wall_clock
from gridmarts.operators.latest import latest_by
from gridmarts.operators.upsert import LANDED
from gridmarts.schemas import API_SOURCE, DA_FEED, FORECAST_FEED, LOAD_FEED, RT_FEED


def _complete(raw: DataFrame, feed: T.StructType) -> DataFrame:
    """Add the feed's absent columns as NULL; types stay as landed."""
    absent = [f for f in feed if f.name not in raw.columns]
    return raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def _with_utc(df: DataFrame, local: str, utc: str, iso_zone: str) -> DataFrame:
    """Add the UTC time.

    As a plain column it would be computed twice wherever it is a join key: the filter on
    NULL keys that Spark adds is moved below the projection, expression and all. A filter
    on the output of explode stays above it, and an array of one costs nothing.
    """
    instant = to_utc(F.col("time_text"), F.col(local), iso_zone)
    return df.select("*", F.explode(F.array(instant)).alias(utc)).drop("time_text")


def _landed(raw: DataFrame) -> list[str]:
    """The landing time goes through where there is one."""
    return [c for c in (LANDED,) if c in raw.columns]


def _stage_prices(
    raw: DataFrame, suffix: str, pnode_type: Column, extra: list[Column], iso_zone: str, strict: bool
) -> DataFrame:
    text = F.col("datetime_beginning_ept")
    total = to_double(F.col(f"total_lmp_{suffix}"))
    staged = raw.filter(total.isNotNull()).select(
        text.alias("time_text"),
        wall_clock(text, strict).alias("hour_beginning_ept"),
        lenient_int(raw, "pnode_id").alias("pnode_id"),
        F.trim("pnode_name").alias("pnode_name"),
        pnode_type.alias("pnode_type"),
        F.trim("zone").alias("zone"),
        to_double(F.col(f"system_energy_price_{suffix}")).alias(f"energy_price_{suffix}"),
        to_double(F.col(f"congestion_price_{suffix}")).alias(f"congestion_price_{suffix}"),
        to_double(F.col(f"marginal_loss_price_{suffix}")).alias(f"loss_price_{suffix}"),
        total.alias(f"total_lmp_{suffix}"),
        *extra,
        *_landed(raw),
    )
    return _with_utc(staged, "hour_beginning_ept", "hour_beginning_utc", iso_zone)


def stage_da(raw: DataFrame, iso_zone: str = "UTC", strict: bool = True) -> DataFrame:
    """Day-ahead prices."""
    kind = F.coalesce(F.trim("type"), F.trim("pnode_type"))
    source = F.coalesce("source", F.lit(API_SOURCE)).alias("source")
    return _stage_prices(_complete(raw, DA_FEED), "da", kind, [source], iso_zone, strict)


def stage_rt(raw: DataFrame, iso_zone: str = "UTC", strict: bool = True) -> DataFrame:
    """Real-time prices."""
    return _stage_prices(_complete(raw, RT_FEED), "rt", F.trim("type"), [], iso_zone, strict)


def stage_load(raw: DataFrame, iso_zone: str = "UTC", strict: bool = True) -> DataFrame:
    """Metered load."""
    raw = _complete(raw, LOAD_FEED)
    text, load = F.col("datetime_beginning_ept"), to_double(F.col("mw"))
    staged = raw.filter(load.isNotNull()).select(
        text.alias("time_text"),
        wall_clock(text, strict).alias("hour_beginning_ept"),
        *[F.trim(c).alias(c) for c in ("zone", "load_area", "nerc_region", "mkt_region")],
        load.alias("load_mw"),
        to_bool(F.col("is_verified")).alias("is_verified"),
        *_landed(raw),
    )
    return _with_utc(staged, "hour_beginning_ept", "hour_beginning_utc", iso_zone)


def stage_forecast(raw: DataFrame, iso_zone: str = "UTC", strict: bool = True) -> DataFrame:
    """Load forecasts, the latest version per area and hour.

    There are many versions of an hour, so they are reduced by their texts first: rows alike in area, hour and time of
    issue in a hash aggregate, then versions of an area and hour. Only what is left has its hour parsed and put
    in UTC, where several texts may mean one hour.
    """
    raw = _complete(raw, FORECAST_FEED)
    issued = raw.groupBy(
        F.trim("forecast_area").alias("forecast_area"),
        F.col("forecast_datetime_beginning_ept").alias("time_text"),
        F.col("evaluated_at_datetime_ept").alias("issue_text"),
    ).agg(F.max(to_double(F.col("forecast_load_mw"))).alias("forecast_load_mw"))
    order = ["evaluated_at_ept", "forecast_load_mw"]
    versions = issued.select(
        "time_text", wall_clock(F.col("issue_text"), strict).alias("evaluated_at_ept"), "forecast_area", "forecast_load_mw"
    )
    newest = latest_by(versions, ["forecast_area", "time_text"], order)
    hour = wall_clock(F.col("time_text"), strict).alias("forecast_hour_ept")
    staged = newest.select("time_text", "evaluated_at_ept", hour, "forecast_area", "forecast_load_mw")
    staged = _with_utc(staged, "forecast_hour_ept", "forecast_hour_utc", iso_zone)
    return latest_by(staged, keys=["forecast_area", "forecast_hour_utc"], order=order)
