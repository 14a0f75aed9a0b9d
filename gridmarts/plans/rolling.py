"""Recent tiers that move with the clock: days are written as they land and go when they are too old.

A tier holds whole local days in a folder each. What has landed since the last run says which days are
written anew; the other folders keep their files, and nothing else of the feed is read. The cut at the very
hour is made on reading.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.functions.timeparse import us_wall_clock
from gridmarts.operators.file_upsert import files_at
from gridmarts.operators.upsert import read_table
from gridmarts.plans.changes import in_days
from gridmarts.plans.tiers import TIME, recent
from gridmarts.schemas import FEEDS
from gridmarts.sources.feeds import FEED_FOLDERS, scan_feed
from gridmarts.sources.sinks import write_partitioned

DAY = FEED_FOLDERS["day"]
Tier = Callable[[DataFrame, datetime | Column, int], DataFrame]


def refresh_recent(
    spark: SparkSession,
    path: str,
    feed: str,
    feed_path: str,
    checkpoint: str,
    tier: Tier,
    as_of: datetime,
    days: int = 7,
    files_per_batch: int = 1000,
) -> None:
    """Bring a stored recent tier to ``as_of``: days with newly landed files are written, days before the window go.

    ``tier`` is :func:`tiers.recent_rt` or :func:`tiers.recent_da`. A late file of a day within the window has that day
    written anew from all its files. Files of older days are passed over, as are rows whose time is not
    US-style, so ``as_of`` must not go back and ``days`` must not grow: start a new folder with a new checkpoint then.
    A day whose files were all taken away stays until it is too old. A run that is repeated after a failure
    changes nothing. What comes to the driver is the list of landed days within the window.
    """
    first = (as_of - timedelta(days=days)).date()

    def add(batch: DataFrame, _epoch: int) -> None:
        landed = batch.select(_day().alias(DAY)).filter(F.col(DAY) >= F.lit(first)).distinct()
        found = sorted(row[0] for row in landed.collect())
        if not found:
            return
        rows = in_days(scan_feed(spark, feed_path, feed), found)
        whole_days = tier(rows, datetime.combine(found[0], time()), 0).withColumn(DAY, _day())
        write_partitioned(whole_days.filter(F.col(DAY).isin(found)), path, DAY, ["pnode_id", TIME], replace_all=False)

    reader = spark.readStream.schema(FEEDS[feed]).option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.option("recursiveFileLookup", True)
        .parquet(feed_path)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    expire(spark, path, first)


def read_recent(spark: SparkSession, path: str, as_of: datetime | Column, days: int = 7) -> DataFrame | None:
    """The rows at most ``days`` before ``as_of``; older folders are not read. None if the tier holds no day at all."""
    stored = read_table(spark, path, merge_schema=False)
    return None if stored is None else recent(stored, TIME, as_of, days).drop(DAY)


def expire(spark: SparkSession, path: str, first: date) -> None:
    """Delete the folders of days before ``first``."""
    place, files = files_at(spark, path)
    if not files.exists(place):
        return
    for folder in files.listStatus(place):
        name, _, day = folder.getPath().getName().partition("=")
        if name == DAY and day < first.isoformat():
            files.delete(folder.getPath(), True)
    spark.catalog.refreshByPath(path)


def _day() -> Column:
    return F.to_date(us_wall_clock(F.col(TIME)))
