"""Figures and curves computed from a series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts.functions.labels import spread_sign
from gridmarts.operators.ranking import rank_descending


def kpi_prices(series: DataFrame, mean: Callable[[Column], Column] = F.avg) -> DataFrame:
    """Mean day-ahead price, real-time price and spread; NULL where there are no values."""
    return series.agg(
        mean(F.col("da")).alias("avg_da"),
        mean(F.col("rt")).alias("avg_rt"),
        mean(F.col("spread")).alias("avg_spread"),
    )


def error_pct_of_actual() -> Column:
    """Absolute error in percent of the actual load; NULL where that is zero."""
    return F.abs(F.try_divide(F.col("actual") - F.col("forecast"), F.col("actual"))) * 100


def kpi_load(series: DataFrame, mean: Callable[[Column], Column] = F.avg) -> DataFrame:
    """Peak load, a missing peak counting as zero, and the mean absolute percentage error."""
    return series.agg(
        F.max(F.coalesce("peak", F.lit(0.0))).alias("peak_load"),
        mean(error_pct_of_actual()).alias("mape"),
    )


def freshness(series: DataFrame) -> DataFrame:
    """Latest time and number of rows."""
    return series.agg(F.max("ts").alias("latest_ts"), F.count("*").alias("row_count"))


def with_spread_sign(series: DataFrame) -> DataFrame:
    return series.withColumn("sign", spread_sign(F.col("spread")))


def duration_curve(
    series: DataFrame, price_col: str = "da", buckets: int | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """(pct_of_hours, price): how much of the time the price is at or above a level.

    The share is rounded half up to one decimal. It is NULL if there is only one price. With ``by``, a curve for each group
    of these columns, all in one pass.
    """
    ranked = rank_descending(series, price_col, buckets, by=by)
    share = F.try_divide(F.col("position"), F.col("total") - 1) * 100
    return ranked.select(
        *by, (F.floor(share * 10 + 0.5) / 10).alias("pct_of_hours"), F.col(price_col).alias("price")
    )
