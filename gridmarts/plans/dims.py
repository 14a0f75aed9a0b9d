"""Dimensions over the day-ahead prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts import schemas as S


def build_dim_pnode(da: DataFrame) -> DataFrame:
    """Every pricing node seen, with a display label and a filter group."""
    nodes = (
        da.filter(F.col("pnode_id").isNotNull())
        .select("pnode_id", "pnode_name", "pnode_type", "zone")
        .distinct()
    )
    home = (F.col("pnode_type") == S.ZONE_TYPE) & (F.col("zone") == S.HOME_ZONE)
    label = (
        F.when(F.col("pnode_id") == S.WESTERN_HUB_ID, S.WESTERN_HUB_LABEL)
        .when(home, S.HOME_ZONE_LABEL)
        .otherwise(F.col("pnode_name"))
    )
    group = F.lit(S.OTHER_GROUP)
    for kind, name in S.GROUP_OF_TYPE.items():
        group = F.when(F.col("pnode_type") == kind, name).otherwise(group)
    return nodes.withColumns({"display_name": label, "pnode_group": group})


def _since_whole_hour(time: Column) -> Column:
    """How far the time is into its hour; all hours of the calendar have the same offset."""
    return time - F.date_trunc("hour", time).cast("timestamp_ntz")


def build_dim_calendar(da: DataFrame) -> DataFrame:
    """One row per local clock hour between the first and the last price."""
    hour = F.col("hour_beginning_ept")
    extent = da.agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    # The one row becomes a row per month; these are spread, and each makes its own hours.
    hours = extent.filter(F.col("first").isNotNull()).select(
        "first", "last",
        F.explode(F.sequence(F.trunc(F.to_date("first"), "month"), F.to_date("last"), F.expr("interval 1 month"))).alias("month"),
    )
    hours = hours.hint("rebalance").select(
        F.explode(
            F.sequence(
                F.greatest("first", F.col("month").cast("timestamp_ntz") + _since_whole_hour(F.col("first"))),
                F.least("last", F.add_months("month", 1).cast("timestamp_ntz") - F.expr("interval 1 second")),
                F.expr("interval 1 hour"),
            )
        ).alias("hour_beginning_ept")
    )
    weekday = F.dayofweek(hour) - 1  # 0 is Sunday
    on_peak = weekday.between(1, 5) & F.hour(hour).between(6, 21)
    return hours.select(
        "hour_beginning_ept",
        F.to_date(hour).alias("date_ept"),
        F.year(hour).cast("bigint").alias("year"),
        F.month(hour).cast("bigint").alias("month"),
        F.dayofmonth(hour).cast("bigint").alias("day"),
        F.hour(hour).cast("bigint").alias("hour_of_day"),
        weekday.cast("bigint").alias("day_of_week"),
        F.date_format(hour, "EEEE").alias("day_name"),
        F.date_format(hour, "MMMM").alias("month_name"),
        on_peak.alias("is_peak"),
    )
