"""Data checks that report violations as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, violations), all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "violations")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL keys do not count."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def observed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """The rows, and what is counted of them while they are written or otherwise run through: ``rows``, and the
    NULLs of each column. ``Observation.get`` has the figures once that has ended, so the check needs no scan of its own.
    """
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    return df.observe(seen, F.count("*").alias("rows"), *nulls), seen
