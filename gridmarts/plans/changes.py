"""Facts and tiers kept up to date by what has landed, not by how new it is.

A price can land weeks after its hour, on either side of the join. Both landed feeds are read as file streams, so
each run sees the files that have arrived since the last one. Their keys say what has to be joined
again, and their days which folders hold it: nothing else of the feeds or of the fact is read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmarts.functions.casts import to_real
from gridmarts.functions.labels import period_start, utc_date
from gridmarts.operators.upsert import FOLDERS, read_table, upsert_table
from gridmarts.plans import staging
from gridmarts.plans.marts import HOUR, build_mart_lmps
from gridmarts.schemas import FEEDS, MART_LMPS_KEY
from gridmarts.sources.feeds import FEED_FOLDERS, scan_feed
from gridmarts.sources.sinks import write_partitioned

Stage = Callable[[DataFrame], DataFrame]


def in_days(feed: DataFrame, days: list) -> DataFrame:
    """Rows in the folders of these local days (or of their months); every row of a feed without folders."""
    for unit, folder in FEED_FOLDERS.items():
        if folder in feed.columns:
            starts = {d.replace(day=1) if unit == "month" else d for d in days}
            feed = feed.filter(F.col(folder).isin(sorted(starts)))
    return feed


def _same(keys: list[str]) -> Column:
    """A NULL in a key counts as a value here, so that rows without an id are joined again, too."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"changed_{k}")) for k in keys])


def rejoined(da: DataFrame, rt: DataFrame, changed: DataFrame) -> DataFrame:
    """Fact rows of the changed keys, made of all that both staged feeds have for them."""
    wanted = changed.select(*[F.col(k).alias(f"changed_{k}") for k in MART_LMPS_KEY]).distinct()
    return build_mart_lmps(*(side.join(wanted, _same(MART_LMPS_KEY), "left_semi") for side in (da, rt)))


def refresh_changed_lmps(
    spark: SparkSession,
    path: str,
    da_path: str,
    rt_path: str,
    checkpoint: str,
    unit: str = "day",
    files_per_batch: int = 1000,
    stage_da: Stage = staging.stage_da,
    stage_rt: Stage = staging.stage_rt,
    touched: Callable[[list], None] | None = None,
) -> None:
    """Bring the fact up to date with every file of the two feeds that has landed since the last call.

    The keys of the new rows are joined again from both feeds, whichever side brought them, and replace the stored
    rows. A run that is repeated after a failure changes nothing. Rows that a rerun of a feed no longer has
    stay in the fact: a file that is gone brings no key. What comes to the driver is the list of days that the new rows have.
    ``touched`` is told the days (UTC) of the fact that were written, for tiers made of it.
    """

    def merge(batch: DataFrame, _epoch: int) -> None:
        columns = set(batch.columns) - {"side"}
        sides = [
            stage(batch.filter(F.col("side") == side).select(*[c for c in FEEDS[feed].names if c in columns]))
            for side, feed, stage in (("da", "da_lmps", stage_da), ("rt", "rt_lmps", stage_rt))
        ]
        changed = reduce(DataFrame.unionByName, [s.select(*MART_LMPS_KEY, "hour_beginning_ept") for s in sides])
        # a local day begins up to a day earlier or later than the day of the same hour in the other feed's texts
        day = F.to_date("hour_beginning_ept")
        around = F.explode(F.array(F.date_sub(day, 1), day, F.date_add(day, 1)))
        days = [r[0] for r in changed.select(around.alias("day")).distinct().collect() if r[0] is not None]
        if not days:
            return
        da = stage_da(in_days(scan_feed(spark, da_path, "da_lmps"), days))
        rt = stage_rt(in_days(scan_feed(spark, rt_path, "rt_lmps"), days))
        upsert_table(spark, path, rejoined(da, rt, changed), MART_LMPS_KEY, HOUR, unit)
        if touched is not None:
            touched([r[0] for r in changed.select(F.to_date(HOUR)).distinct().collect()])

    query = (
        _landing(spark, da_path, "da_lmps", "da", files_per_batch)
        .unionByName(_landing(spark, rt_path, "rt_lmps", "rt", files_per_batch), allowMissingColumns=True)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _landing(spark: SparkSession, path: str, feed: str, side: str, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.schema(FEEDS[feed]).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", True).parquet(path).withColumn("side", F.lit(side))


# --- daily tiers out of partial sums ----------------------------------------------

EXACT = "decimal(38,6)"
_AVERAGED = {"total_lmp_da": "avg_lmp_da", "total_lmp_rt": "avg_lmp_rt", "da_rt_spread": "avg_spread"}
NODE_DAY = ["date_utc", "pnode_id", "pnode_name", "zone"]


def lmp_partials(mart: DataFrame, day_zone: str = "UTC") -> DataFrame:
    """Per day and node what daily figures are made of: sums, counts, extremes. Partials of parts of a day add up.

    Sums are decimals, so they do not depend on the order in which parts are folded.
    """
    day = utc_date(F.col(HOUR), day_zone).alias("date_utc")
    sums = [F.sum(F.col(c).cast("decimal(18,6)")).cast(EXACT).alias(f"sum_{c}") for c in _AVERAGED]
    counts = [F.count(c).alias(f"n_{c}") for c in _AVERAGED]
    extremes = [F.min("total_lmp_da").alias("min_lmp_da"), F.max("total_lmp_da").alias("max_lmp_da")]
    return mart.groupBy(day, *NODE_DAY[1:]).agg(*sums, *counts, *extremes, F.count("*").alias("hours"))


def fold(partials: DataFrame) -> DataFrame:
    """One partial out of several of the same day and node."""
    sums = [F.sum(f"sum_{c}").cast(EXACT).alias(f"sum_{c}") for c in _AVERAGED]
    counts = [F.sum(f"n_{c}").alias(f"n_{c}") for c in _AVERAGED]
    extremes = [F.min("min_lmp_da").alias("min_lmp_da"), F.max("max_lmp_da").alias("max_lmp_da")]
    return partials.groupBy(*NODE_DAY).agg(*sums, *counts, *extremes, F.sum("hours").alias("hours"))


def daily_of(partials: DataFrame) -> DataFrame:
    """The daily tier of folded partials."""

    def mean(column: str) -> Column:
        return to_real(F.try_divide(F.col(f"sum_{column}").cast("double"), F.col(f"n_{column}")))

    means = {name: mean(column) for column, name in _AVERAGED.items()}
    low, high = (to_real(F.col(c)).alias(c) for c in ("min_lmp_da", "max_lmp_da"))
    return partials.select(
        *NODE_DAY, means["avg_lmp_da"].alias("avg_lmp_da"), means["avg_lmp_rt"].alias("avg_lmp_rt"), low, high,
        means["avg_spread"].alias("avg_spread"), "hours",
    )


def refresh_daily(spark: SparkSession, fact: str, path: str, days: list | None = None) -> None:
    """Write the partials of these UTC days anew from the fact, by month; all days if None.

    Only the fact's folders of those days are read, and only the months that hold them are written: the other days of such a
    month are taken over from the stored partials. A day of which the fact has nothing left goes.
    """
    rows = read_table(spark, fact, merge_schema=False)
    if rows is None or days == []:
        return
    stored = None
    if days is not None:
        for unit, folder in FOLDERS.items():
            if folder in rows.columns:
                starts = {d.replace(day=1) if unit == "month" else d for d in days if d is not None}
                missing = F.col(folder).isNull() if None in days else F.lit(False)
                rows = rows.filter(F.col(folder).isin(sorted(starts)) | missing)
        rows = rows.filter(_among(F.to_date(HOUR), days))
        months = sorted({d.replace(day=1) for d in days if d is not None})
        names = [f"month_utc={m}" for m in months] + ["month_utc=__HIVE_DEFAULT_PARTITION__"] * (None in days)
        stored = read_table(spark, path, *names, merge_schema=False)
    fresh = lmp_partials(rows)
    if stored is not None:
        others = stored.drop("month_utc").filter(~_among(F.col("date_utc"), days))
        fresh = others.unionByName(fresh)
    by_month = fresh.withColumn("month_utc", period_start(F.col("date_utc").cast(T.TimestampNTZType()), "month"))
    write_partitioned(by_month, path, "month_utc", ["pnode_id", "date_utc"], replace_all=days is None)


def _among(day: Column, days: list) -> Column:
    known = F.coalesce(day.isin([d for d in days if d is not None]), F.lit(False))
    return known | day.isNull() if None in days else known


def read_daily(spark: SparkSession, path: str) -> DataFrame | None:
    """The daily tier as its stored partials give it."""
    partials = read_table(spark, path, merge_schema=False)
    return None if partials is None else daily_of(partials.drop("month_utc"))
