"""Packing documents into sequences by best-two-fit.

Only documents longer than a sequence are cut: into whole sequences, with the rest as the first
piece. What a packing needs to know of the other pieces is how many there are of each length, at most
one count per token of a sequence. The plan is made on these counts:

- fill a sequence greedily, each time with the longest piece that fits;
- then look whether two unpacked pieces fit the gap that the sequence's smallest piece would
  leave, more tightly than that piece does, and if so swap them in;
- use the pattern as often as the counts allow.

Pieces of a length are numbered without bringing them together (counts by length and hash
bucket, prefix sums, a row number within each bucket), and a pattern takes a range of the numbers
of each of its lengths. So the plan, and what is broadcast of it, is bounded by the sequence
length, whatever the number of documents.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmarts.llm.common import ready, scratch, whole_text
from gridmarts.llm.pretokens import word_cache
from gridmarts.llm.shingles import in_pieces

PIECE = "piece int, start long, length long, ids_crc32 long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens; the first may be shorter."""
    if n <= size:
        return [(0, n)]
    rest = n % size
    return ([(0, rest)] if rest else []) + [(at, size) for at in range(rest, n, size)]


def _pieces(vocabulary: str, end_id: int | None, size: int):
    def run(batches):
        cache = word_cache(vocabulary)
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        for frame in batches:
            texts, ids = frame["text"].to_list(), frame["id"].to_list()
            for lo, hi in in_pieces(texts, 1_000_000):
                rows = []
                for doc, tokens in zip(ids[lo:hi], cache.encode(texts[lo:hi])):
                    tokens = np.concatenate([tokens, end]).astype("<u4")
                    for k, (at, n) in enumerate(cut(len(tokens), size)):
                        rows.append((doc, k, at, n, zlib.crc32(tokens[at : at + n].tobytes())))
                out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"id": "Int64"})

    return run


def plan(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns as (times, lengths in descending order) that use up all pieces of 1..size."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    patterns = []

    def drop(n: int) -> None:
        del lengths[bisect_right(lengths, n) - 1]

    while lengths:
        used: dict[int, int] = {}

        def free(n: int) -> int:
            return left[n] - used.get(n, 0)

        gap, items = size, []
        at = len(lengths) - 1
        while at >= 0 and lengths[0] <= gap:
            at = min(at, bisect_right(lengths, gap) - 1)
            if at < 0:
                break
            if not free(lengths[at]):
                at -= 1
                continue
            items.append(lengths[at])
            used[lengths[at]] = used.get(lengths[at], 0) + 1
            gap -= lengths[at]
        if gap and len(items) > 1:
            smallest = items[-1]
            pair = _best_two(lengths, free, gap + smallest, smallest)
            if pair:
                used[smallest] -= 1
                items[-1:] = pair
                for n in pair:
                    used[n] = used.get(n, 0) + 1
        times = min(left[n] // k for n, k in used.items() if k)
        patterns.append((times, sorted(items, reverse=True)))
        for n, k in used.items():
            left[n] -= k * times
            if k and not left[n]:
                drop(n)
    return patterns


def _best_two(lengths: list[int], free, gap: int, than: int) -> tuple[int, int] | None:
    """The two unpacked pieces with the largest sum up to ``gap``, if it is above ``than``."""
    best, pair = than, None
    lo, hi = 0, bisect_right(lengths, gap) - 1
    while lo <= hi and best < gap:
        a, b = lengths[lo], lengths[hi]
        if not free(b) or a + b > gap:
            hi -= 1
        elif not free(a) or (lo == hi and free(a) < 2):
            lo += 1
        else:
            if a + b > best:
                best, pair = a + b, (b, a)
            lo += 1
    return pair


def slots(patterns: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """Where the pieces of each length go: a row per pattern and length.

    The piece of that length numbered r, with first <= r < first + times * each, goes to sequence
    ``sequence + (r - first) mod times`` at ``offset + (r - first) div times * length``.
    """
    rows, taken, sequence = [], {}, 0
    for times, items in patterns:
        offset = 0
        for n in sorted(set(items), reverse=True):
            each = items.count(n)
            first = taken.get(n, 0)
            rows.append((n, first, first + times * each, times, sequence, offset))
            taken[n] = first + times * each
            offset += n * each
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "last", "times", "sequence", "offset0"]).astype("int64")


def place_pieces(pieces: DataFrame, size: int, tie: list[str], bucket_rows: int = 100_000) -> DataFrame:
    """``pieces`` (with a ``length`` of 1..size) with ``sequence_id`` and ``offset``.

    ``pieces`` should be a stored table, as it is read three times. ``tie`` are the columns that order
    pieces of a length; rows alike in all of them may change places.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().toPandas()  # at most ``size`` rows
    held = dict(zip(counted["length"].tolist(), counted["count"].tolist()))
    where = slots(plan(held, size))
    if where.empty:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    buckets = max(1, math.ceil(sum(held.values()) / bucket_rows))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64(*tie), F.lit(buckets)))
    sums = rows.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("length", "bucket").orderBy(*tie)
    numbered = rows.withColumn("number", F.row_number().over(inner)).join(sums, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("number") - 1 + F.col("base")).drop("base", "bucket")
    table = F.broadcast(spark.createDataFrame(where))
    found = numbered.join(table, "length").where("number >= first and number < last")
    return found.withColumns({
        "sequence_id": F.col("sequence") + (F.col("number") - F.col("first")) % F.col("times"),
        "offset": F.expr("offset0 + (number - first) div times * length"),
    }).drop("number", "first", "last", "times", "sequence", "offset0")


def packed(
    documents: DataFrame,
    vocabulary: str,
    end_id: int | None = 0,
    size: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty; an empty text is the end id alone (with ``end_id=None`` it has no
    piece). Rows that repeat an id are documents of their own and appear as often. A null id stays null. Other columns
    are ignored. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    ready(spark)
    with scratch(spark, "two-fit") as tables:
        rows = documents.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
        pieces = rows.mapInPandas(_pieces(vocabulary, end_id, size), f"id long, {PIECE}").where("length > 0")
        pieces = tables.store(pieces, "pieces")
        placed = place_pieces(pieces, size, ["id", "piece", "start", "ids_crc32"])
        return tables.store(
            placed.select(F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"),
            "result",
        )
