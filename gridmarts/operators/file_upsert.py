"""Upsert that rewrites the files with a key of the batch, not their whole folders."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmarts.functions.labels import period_start
from gridmarts.operators.upsert import FOLDERS, merge_batch, newest_per_key, read_table, sorting
from gridmarts.session import shared_folder
from gridmarts.sources.sinks import write_partitioned

# Spark skips names that begin with an underscore.
STAGED, REPLACED = "_staged", "_replaced"


def holding_files(touched: DataFrame, batch: DataFrame, keys: list[str], time_col: str) -> list[str]:
    """The files of the touched folders that hold a key of the batch.

    Only key columns are read, and of those only row groups between the batch's first and last time where times have
    no zone, as both bounds are literals in the plan. A NULL in a key counts as a value here. What comes to the driver is
    file names, at most those of the touched folders.
    """
    kind = batch.schema[time_col].dataType
    first, last = batch.agg(*[f(time_col).cast("string") for f in (F.min, F.max)]).first()
    if first is not None and isinstance(kind, T.TimestampNTZType):  # its text is exact
        within = F.col(time_col).between(F.lit(first).cast(kind), F.lit(last).cast(kind))
        touched = touched.filter(within | F.col(time_col).isNull())
    wanted = batch.select(*[F.col(k).alias(f"wanted_{k}") for k in keys]).distinct()
    same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in keys])
    rows = touched.select(*keys, F.col("_metadata.file_path").alias("holding_file"))
    return [r[0] for r in rows.join(wanted, same, "left_semi").select("holding_file").distinct().collect()]


def upsert_files(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], time_col: str, unit: str = "day"
) -> list[str]:
    """Merge ``batch`` into the table at ``path``; returns the names of the files that were replaced.

    Gives the rows that :func:`gridmarts.operators.upsert.upsert_table` gives, for batches that are small beside their
    folders: files without a key of the batch stay as they are. New files are written beside the table
    first and the names of the old ones with them. If the driver dies while they change
    places, the next call carries the exchange through before it does anything else; one writer at a time.
    """
    finish_exchange(spark, path)
    folder = FOLDERS[unit]
    own = f"{shared_folder(spark)}/upsert-batch-{uuid.uuid4().hex}"
    rows = newest_per_key(batch, keys).withColumn(folder, period_start(F.col(time_col), unit))
    rows.write.parquet(own)  # read four times below, and often the result of a large join
    try:
        batch = spark.read.schema(rows.schema).parquet(own)
        starts = [row[0] for row in batch.select(folder).distinct().collect()]
        if not starts:
            return []
        names = [f"{folder}={start or '__HIVE_DEFAULT_PARTITION__'}" for start in starts]
        touched = read_table(spark, path, *names, merge_schema=False)
        old = [] if touched is None else [_plain(spark, f) for f in holding_files(touched, batch, keys, time_col)]
        merged = batch
        if old:
            held = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*old)
            merged = merge_batch(held, batch, keys)
        write_partitioned(merged, f"{path}/{STAGED}", folder, sorting(keys, time_col))
        # the list is complete or absent: its _SUCCESS comes last
        spark.createDataFrame([(f,) for f in old], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{REPLACED}")
        finish_exchange(spark, path)
        return old
    finally:
        place, files = files_at(spark, own)
        files.delete(place, True)


def finish_exchange(spark: SparkSession, path: str) -> None:
    """Move staged files into the table and delete those they replace; drop what was staged without a list.

    Every step can be repeated: a file that has moved is no longer staged, one that is gone is not deleted again.
    """
    listed, files = files_at(spark, f"{path}/{REPLACED}")
    staged, _ = files_at(spark, f"{path}/{STAGED}")
    if files.exists(files_at(spark, f"{path}/{REPLACED}/_SUCCESS")[0]):
        old = [r[0] for r in spark.read.text(f"{path}/{REPLACED}").collect()]
        folders = files.listStatus(staged) if files.exists(staged) else []
        for folder in folders:
            if not folder.isDirectory():
                continue
            target, _ = files_at(spark, f"{path}/{folder.getPath().getName()}")
            files.mkdirs(target)
            for file in files.listStatus(folder.getPath()):
                to, _ = files_at(spark, f"{path}/{folder.getPath().getName()}/{file.getPath().getName()}")
                if not files.rename(file.getPath(), to):
                    raise OSError(f"could not move {file.getPath()} to {to}")
        for name in old:
            files.delete(files_at(spark, name)[0], False)
        spark.catalog.refreshByPath(path)
    files.delete(staged, True)
    files.delete(listed, True)


def files_at(spark: SparkSession, path: str):
    """The path as the store knows it, and the store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _plain(spark: SparkSession, name: str) -> str:
    """The metadata column gives names as URIs, with blanks and the like encoded."""
    uri = spark._jvm.java.net.URI(name)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()
