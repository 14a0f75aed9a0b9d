"""Reading and combining landed feeds."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmarts.functions.labels import day_start, parse_day, period_start
from gridmarts.functions.timeparse import naive, wall_clock
from gridmarts.schemas import FEEDS

# Folder names of a feed written by this library: the local day or month of its rows.
FEED_FOLDERS = {"day": "feed_date", "month": "feed_month"}
# Above them, a folder per part of the feed.
FEED_PART = "feed_part"


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the columns of ``schema`` (and those to ``keep``): absent ones NULL, unreadable values NULL."""
    columns = []
    for field in schema:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif df.schema[field.name].dataType == field.dataType:
            columns.append(F.col(field.name))
        else:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    extra = [c for c in FEED_FOLDERS.values() if c in df.columns]
    return df.select(*columns, *extra, *keep)


def scan_feed(
    spark: SparkSession,
    paths: str | list[str],
    feed: str,
    landed: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """A feed's Parquet files, in the feed's schema.

    The files may lack columns, which come out as NULL. ``landed`` states the physical
    types where they differ from the feed's own (ids stored as numbers, say). ``infer``
    takes them from the file footers instead. No file is opened for its schema
    otherwise.
    """
    paths = [paths] if isinstance(paths, str) else paths
    if infer:
        raw = spark.read.option("mergeSchema", "true").parquet(*paths)
    else:
        raw = spark.read.schema(landed or FEEDS[feed]).parquet(*paths)
    return conform(raw, FEEDS[feed])


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """One feed out of several; a column that a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def first_landed(spark: SparkSession, feed_paths: Iterable[tuple[str, str]]) -> tuple[str, DataFrame]:
    """The first of the (feed, path) pairs that holds any files."""
    tried = []
    for feed, path in feed_paths:
        try:
            df = scan_feed(spark, path, feed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            tried.append(path)
            continue
        if not df.isEmpty():
            return feed, df
        tried.append(path)
    raise FileNotFoundError(f"no landed files in {', '.join(tried)}")


def prune_folders(df: DataFrame, first: Column, last: Column | None = None) -> DataFrame:
    """Skip whole folders of a feed laid out by day or month; a no-op on others."""
    for unit, folder in FEED_FOLDERS.items():
        if folder in df.columns:
            df = df.filter(F.col(folder) >= period_start(first, unit))
            df = df if last is None else df.filter(F.col(folder) <= last)
    return df


def feed_window(
    raw: DataFrame,
    start: str | date,
    end: str | date | None = None,
    time_col: str = "datetime_beginning_ept",
    today: date | None = None,
    **equals: str,
) -> DataFrame:
    """Rows of the local days ``start`` to ``end``, hours 00:00 to 23:00, that match ``equals``."""
    first = parse_day(start, today)
    last = parse_day(end, today) if end is not None else first
    rows = prune_folders(raw, F.lit(first), F.lit(last))
    for name, value in equals.items():
        rows = rows.filter(F.col(name) == value)
    begin = naive(day_start(first))
    final = naive(day_start(last).replace(hour=23))
    if first == last:
        final = naive(day_start(last).replace(hour=23, minute=59, second=59))
    return rows.filter(wall_clock(F.col(time_col), strict=False).between(begin, final))
