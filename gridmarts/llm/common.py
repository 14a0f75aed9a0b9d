"""What the operators of this folder share: intermediate tables, components, column care."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.session import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Let Python workers that start elsewhere find this package."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, ROOT]))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables in the shared folder. A lost executor costs only the tasks since the last one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them again, which also cuts the lineage."""
        path = new_folder(self.spark, f"{self.name}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths[path] = name
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove the tables stored so far under these names."""
        for path in [p for p, n in self.paths.items() if n in names]:
            remove_folder(self.spark, path)
            del self.paths[path]


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Scratch]:
    """Intermediate tables that go at the end, but for the one stored as ``result``."""
    tables = Scratch(spark, name)
    try:
        yield tables
    finally:
        for left in {*tables.paths.values()} - {"result"}:
            tables.drop(left)


def components(links: DataFrame, tables: Scratch, rounds: int = 60) -> DataFrame:
    """(node, component) of undirected links (a, b); component is the smallest node reachable.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then
    its smaller ones, to the smallest neighbour. The links become stars around the smallest
    nodes in a number of rounds that grows with the logarithm of the longest path. Minima
    are aggregated before the shuffle and heavy nodes are left to adaptive skew splitting.
    Stored links are small on disk for their number of rows, so they are not broadcast for their size there.
    """
    stars = tables.store(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "stars0",
    )
    before = None
    for step in range(1, rounds + 1):
        both = stars.union(stars.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        handed = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = tables.store(handed.union(small.select("u", "m")).distinct(), f"stars{step}")
        tables.drop(f"stars{step - 1}")
        after = stars.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return stars.toDF("node", "component")
        before = after
    raise RuntimeError(f"components still change after {rounds} rounds")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"_{name}{i or ''}" for i in range(len(taken) + 1)) if n not in taken)


def whole_text(column: str = "text"):
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def usable_vector(column: str):
    """True for vectors that are not null, not zero, and hold finite components only."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def deal_blocks(rows: DataFrame, keys: list[str], own: str, size: str, block: int) -> DataFrame:
    """Cut each group of ``keys`` into blocks by ``own`` and replicate rows to pairs of blocks.

    Adds p <= q, the pair of blocks, and side: 0 or 1 for the first or second block of a pair,
    2 where a block meets itself. ``size`` is the column with the number of rows of a group.
    Two rows of a group meet in exactly one pair of blocks.
    """
    cut = rows.withColumn("cuts", F.ceil(F.col(size) / block).cast("int")).withColumn(
        "own_block", F.pmod(F.xxhash64(own), "cuts").cast("int")
    )
    dealt = cut.withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return dealt.withColumns({
        "p": F.least("own_block", "other_block"),
        "q": F.greatest("own_block", "other_block"),
        "side": F.expr("case when own_block = other_block then 2 when own_block < other_block then 0 else 1 end"),
    }).drop("cuts", "own_block", "other_block")
