"""Landed files into a keyed table, as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmarts.operators.upsert import LANDED, upsert_table


def stream_upsert(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    stage: Callable[[DataFrame], DataFrame],
    target: str,
    keys: list[str],
    time_col: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    unit: str = "day",
) -> None:
    """Merge every file that has arrived since the last call, then stop.

    Each micro-batch goes through the same upsert as a batch run. Of rows with the same
    key the one in the newer file counts, whether the files share a micro-batch or not, so
    ``files_per_batch`` does not change the result. ``stage`` has to hand on the column
    ``landed_at``, as the staging functions do. A batch that is repeated after a failure changes nothing.
    """

    def merge(batch: DataFrame, _epoch: int) -> None:
        upsert_table(spark, target, stage(batch), keys, time_col, unit)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landed)
        .select("*", F.col("_metadata.file_modification_time").alias(LANDED))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
