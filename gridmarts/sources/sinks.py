"""Partitioned Parquet datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.functions.labels import period_start
from gridmarts.functions.timeparse import wall_clock
from gridmarts.sources.feeds import FEED_FOLDERS, FEED_PART


def write_feed(
    df: DataFrame,
    path: str,
    time_col: str = "datetime_beginning_ept",
    unit: str = "day",
    part: str = "feed",
) -> None:
    """Land a part of a feed in a folder of its own, with a folder per local day or month.

    ``part`` names where the rows come from, such as zones, hubs or a file; parts share
    days without touching each other. A rerun of a part replaces the folders it brings rows for and
    no others, so it has to bring them whole. Rows with an unreadable time share one folder of the part. Months
    suit feeds of a few thousand rows a day.
    """
    path = f"{path}/{FEED_PART}={part}"
    start = period_start(wall_clock(F.col(time_col), strict=False), unit)
    folder = FEED_FOLDERS[unit]
    write_partitioned(df.withColumn(folder, start), path, folder, replace_all=False)


def write_partitioned(
    df: DataFrame,
    path: str,
    part: str,
    sort_cols: list[str] | None = None,
    replace_all: bool = True,
) -> None:
    """One folder per value of ``part``, each in files of a sensible size.

    Rebalancing lets adaptive execution cut a large folder over many tasks and gather
    small ones. Sorting inside the files makes their statistics useful for skipping.
    """
    writer = (
        df.hint("rebalance", F.col(part))
        .sortWithinPartitions(part, *(sort_cols or []))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    )
    writer.partitionBy(part).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_missing_periods(df: DataFrame, path: str, period: str) -> None:
    """Add the periods that the dataset at ``path`` does not have; leave the others alone.

    NULL is a period like any other. The period is a folder name, so no data column of the
    stored files is read.
    """
    try:
        stored = df.sparkSession.read.parquet(path).select(period).distinct()
        # Partition folder names are typed on reading, so compare as text.
        stored = stored.select(F.col(period).cast("string").alias("stored_period"))
        same = F.col(period).cast("string").eqNullSafe(F.col("stored_period"))
        df = df.join(stored, same, "left_anti")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    df.hint("rebalance", F.col(period)).write.mode("append").partitionBy(period).parquet(path)
