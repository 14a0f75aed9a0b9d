"""Tables of the session's catalog, whose folders are known without looking at files.

The catalog lists a table's partitions. The newest folder, the periods that are missing and the extent of the
history are answered from that list: no file is opened, no folder is listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the folder of rows without a period.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


def save_table(df: DataFrame, table: str, part: str, path: str, sort_cols: list[str] | None = None) -> None:
    """Write a table anew at ``path``, a folder per value of ``part``, and enter it in the catalog."""
    rows = df.hint("rebalance", F.col(part)).sortWithinPartitions(part, *(sort_cols or []))
    rows.write.mode("overwrite").partitionBy(part).option("path", path).saveAsTable(table)


def periods(spark: SparkSession, table: str, part: str) -> DataFrame:
    """(period): the values of the table's one partition column as text, NULL for rows without; from the catalog alone."""
    folders = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.url_decode(F.regexp_replace(F.substring("partition", len(part) + 2, 1_000), r"\+", "%2B"))
    return folders.select(F.nullif(value, F.lit(NO_PERIOD)).alias("period"))


def extent(spark: SparkSession, table: str, part: str) -> DataFrame:
    """(first_period, last_period) of the stored history."""
    return periods(spark, table, part).agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"))


def newest_rows(spark: SparkSession, table: str, part: str) -> DataFrame:
    """The rows of the newest folder; its name goes into the plan as a literal."""
    newest = extent(spark, table, part).first()["last_period"]
    rows = spark.table(table)
    return rows.filter(F.lit(False)) if newest is None else rows.filter(F.col(part) == F.lit(newest).cast(rows.schema[part].dataType))


def high_mark(spark: SparkSession, table: str, part: str, time_col: str):
    """The greatest ``time_col``, of which only the newest folder is read; None if there are no rows."""
    return newest_rows(spark, table, part).agg(F.max(time_col)).first()[0]


def rows_after_mark(source: DataFrame, table: str, part: str, time_col: str, lookback_hours: int = 0) -> DataFrame:
    """Source rows after the newest stored one, less the lookback; all of them if nothing is stored.

    The mark is a literal in the plan, so it reaches the scan of the source.
    """
    mark = high_mark(source.sparkSession, table, part, time_col)
    if mark is None:
        return source
    return source.filter(F.col(time_col) > F.lit(mark) - F.make_dt_interval(hours=F.lit(lookback_hours)))


def add_missing_periods(df: DataFrame, table: str, part: str) -> None:
    """Append the periods that the table does not have; leave the others alone. NULL is a period like any other."""
    stored = periods(df.sparkSession, table, part)
    new = df.join(stored, F.col(part).cast("string").eqNullSafe(F.col("period")), "left_anti")
    columns = df.sparkSession.table(table).columns
    new.hint("rebalance", F.col(part)).select(*columns).write.insertInto(table)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> None:
    """Write a table anew, dealt and sorted by its keys.

    Two tables with the same keys and number of buckets join on these keys without a shuffle. With the hour among the
    keys no bucket depends on a single node. The rows of a bucket should fit a task: some hundred MB each.
    """
    rows = df.repartition(buckets, *keys)  # one file per bucket
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
