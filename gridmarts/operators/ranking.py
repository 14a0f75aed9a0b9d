"""Global ranking without a single-task sort."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmarts.session import ready_to_checkpoint

ROWS_PER_CHUNK = 100_000
VALUES_PER_BUCKET = 1_000_000
MOST_BUCKETS = 4096  # the totals of so many ranges are broadcast


def rank_descending(
    df: DataFrame,
    value: str,
    buckets: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """(position, value, total) for every non-NULL value, position 0 being the greatest.

    Equal values are counted before anything is ordered, so a value that fills a third
    of the input is one row here. The distinct values are cut into ranges at quantiles;
    a range is ordered by one task, and the ranges are lined up by their totals, of
    which there are at most ``buckets``; by default as many as the distinct values fill.
    With ``by``, each group of these columns (which come first in the result) has positions of its own. A group
    is cut at the same ranges, so one that has most of the rows is ordered by as many tasks. NULL is a group like others.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("copies"))
    # Read three times below; the checkpoint makes all three see the same rows.
    ready_to_checkpoint(df.sparkSession)
    counted = counted.checkpoint()
    distinct, rows = counted.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    buckets = buckets or min(MOST_BUCKETS, ceil(distinct / VALUES_PER_BUCKET) or 1)
    steps = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(counted.approxQuantile(value, steps, 1 / (4 * buckets)))) if steps else []
    ranged = counted.withColumn("bucket", _bucket(F.col(value), cuts, 0, len(cuts)))

    totals = ranged.groupBy(*by, "bucket").agg(F.sum("copies").alias("copies"))
    lined_up = Window.partitionBy(*by).orderBy("bucket")  # over at most `buckets` rows
    everything = lined_up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        *[F.col(c).alias(f"of_{c}") for c in by],
        F.col("bucket").alias("of_bucket"),
        (F.sum("copies").over(lined_up) - F.col("copies")).alias("start"),
        F.sum("copies").over(everything).alias("total"),
    )
    within = Window.partitionBy(*by, "bucket").orderBy(F.col(value).desc())
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*by, "bucket")])
    placed = ranged.withColumn("before", F.sum("copies").over(within) - F.col("copies")).join(
        starts if by else F.broadcast(starts), same
    )
    return _repeat(placed, (*by, value), rows, rows_per_chunk)


def _bucket(value: Column, cuts: list[float], low: int, high: int) -> Column:
    """Number of cuts above the value, found by halving; bucket 0 holds the greatest values."""
    if low == high:
        return F.lit(len(cuts) - low)
    middle = (low + high) // 2
    return F.when(value < cuts[middle], _bucket(value, cuts, low, middle)).otherwise(
        _bucket(value, cuts, middle + 1, high)
    )


def _repeat(placed: DataFrame, values: tuple[str, ...], rows: int, rows_per_chunk: int) -> DataFrame:
    """One row per copy. Many copies are written out by many tasks, a chunk each."""
    chunks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / rows_per_chunk))
    first = F.col("start") + F.col("before")
    # A number of its own, since a chunk is a small row until it is written out and adaptive
    # execution would otherwise pack all of them into one task. It follows the rows to write.
    tasks = max(1, ceil(rows / (10 * rows_per_chunk)))
    chunked = placed.select(
        *values, "total", first.alias("first"), "copies", F.explode(chunks).alias("chunk")
    ).repartition(tasks, *values, "chunk")
    low = F.col("chunk") * rows_per_chunk
    high = F.least(low + rows_per_chunk, F.col("copies")) - 1
    return chunked.select(
        *values, "total", "first", F.explode(F.sequence(low, high)).alias("copy")
    ).select(*values[:-1], (F.col("first") + F.col("copy")).alias("position"), values[-1], "total")
