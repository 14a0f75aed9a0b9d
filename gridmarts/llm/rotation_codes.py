"""Near duplicates among embeddings by randomised-rotation binary codes.

Every vector is turned by random rotations. The signs of the turned components serve twice:

- slices of them are bucket keys (``tables`` of ``bits`` signs each); only vectors that meet
  in a bucket are compared;
- the signs of the first rotation are the code of the vector, kept with its correction
  factor f, the inner product of the code and the vector it stands for. For a code x and a
  whole vector y, sign(x').y' / (sqrt(D) f) is an unbiased estimate of x.y. Its standard
  error for a pair at the threshold c is sqrt(1-f^2)/f * sqrt(1-c^2) / sqrt(D-1). A pair whose
  estimate lies ``sigmas`` errors below the threshold is rejected; every other pair is
  computed anew in double precision, so a link reported is a link.

A pair at the threshold meets in a table with probability (1 - angle/pi)^bits. ``bits``
follows the number of vectors, so that buckets of unrelated vectors stay small, and
``tables`` follows from ``miss``, the probability of missing a pair exactly at the threshold
(closer pairs are missed far more rarely).

Equal vectors are one row with a weight from the start. A bucket with more than ``block``
vectors is cut into blocks, each pair of blocks is a task of its own, and a task returns a
row per vector (its count of links and the smallest vector it is tied to), never pairs. A
pair that meets in several tables is counted in the first.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import Scratch, components, deal_blocks, ready, scratch, usable_vector

SEED = 20_240_501


@lru_cache(maxsize=4)
def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations of that dimension, the same on every machine."""
    made = []
    for k in range(count):
        q, r = np.linalg.qr(np.random.default_rng([SEED, dim, k]).normal(size=(dim, dim)))
        made.append(q * np.sign(np.diag(r)))
    return np.concatenate(made, axis=1)


def plan_tables(vectors: int, cosine: float, miss: float) -> tuple[int, int]:
    """Signs in a key and number of tables."""
    bits = min(48, max(12, math.ceil(math.log2(max(vectors, 2))) + 4))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-meet))


def bucket_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    dim = unit.shape[1]
    turned = unit @ rotations(dim, math.ceil(bits * tables / dim))[:, : bits * tables]
    signs = (turned > 0).reshape(len(unit), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``count`` rows the smallest row tied to it by the links a-b."""
    label = np.arange(count)
    while True:
        was = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == was).all():
            return label


def _unit(batches):
    """Vectors of length 1; the largest component goes first, so that no square over- or underflows."""
    for frame in batches:
        units = []
        for v in frame["v"]:
            w = np.asarray(v, dtype=np.float64)
            w = w / np.abs(w).max()
            units.append(w / math.sqrt(w @ w))
        yield pd.DataFrame({"vec": frame["vec"].astype("Int64"), "unit": units})


def _keyed(bits: int, tables: int):
    def keys(batches):
        for frame in batches:
            for dim, part in frame.groupby(frame["unit"].map(len)):
                unit = np.stack(part["unit"].to_list())
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(),
                    "dim": np.int32(dim),
                    "keys": list(bucket_keys(unit, bits, tables)),
                })

    return keys


def _compare(cosine: float, sigmas: float, tile: int = 512):
    """Count the links within each bucket, or between two blocks of a large one."""

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["dim", "tab", "key", "p", "q", "id"], kind="stable")
        out = [_one_dim(part) for _, part in frame.groupby("dim")]
        return pd.concat(out, ignore_index=True)

    def _one_dim(frame: pd.DataFrame) -> pd.DataFrame:
        ids, weight = frame["id"].to_numpy(), frame["weight"].to_numpy()
        side, table = frame["side"].to_numpy(), frame["tab"].to_numpy()
        unit = np.stack(frame["unit"].to_list())
        keys = np.stack(frame["keys"].to_list())
        dim = unit.shape[1]
        turned = (unit @ rotations(dim, 1)).astype(np.float32)
        code = np.where(turned > 0, 1, -1).astype(np.float32)
        factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
        error = np.sqrt(np.clip(1 - factor**2, 0, 1)) / factor * math.sqrt(1 - cosine**2) / math.sqrt(max(dim - 1, 1))
        least = (cosine - sigmas * error - 1e-4)[:, None]
        code /= (math.sqrt(dim) * factor)[:, None]

        groups = frame[["tab", "key", "p", "q"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])
        found, root, hit = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids)), []
        for lo, hi in zip(starts, np.r_[starts[1:], len(ids)]):
            both = side[lo] == 2
            first = lo + np.flatnonzero(side[lo:hi] != 1)
            second = first if both else lo + np.flatnonzero(side[lo:hi] == 1)
            ends = []
            for i in range(0, len(first), tile):
                rows = first[i : i + tile]
                for j in range(0, len(second), tile):
                    cols = second[j : j + tile]
                    r, c = np.nonzero(code[rows] @ turned[cols].T >= least[rows])
                    a, b = rows[r], cols[c]
                    if both:
                        a, b = a[a < b], b[a < b]
                    for k in range(0, len(a), 1 << 14):
                        x, y = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
                        new = ~(keys[x, : table[lo]] == keys[y, : table[lo]]).any(axis=1)
                        x, y = x[new], y[new]
                        true = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                        x, y = x[true], y[true]
                        np.add.at(found, x, weight[y])
                        np.add.at(found, y, weight[x])
                        ends.append((x, y))
            if any(len(x) for x, _ in ends):
                x, y = (np.concatenate(e) for e in zip(*ends))
                root[lo:hi] = lo + _roots(hi - lo, x - lo, y - lo)
        hit = found > 0
        return pd.DataFrame({"id": ids[hit], "links": found[hit], "root": ids[root[hit]]})

    return links


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.95,
    miss: float = 1e-5,
    sigmas: float = 6.0,
    block: int = 2048,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, zero, or hold null or non-finite components link with nothing and
    are kept. Vectors of different dimension never link. A repeated id is a vector of its own
    for the counts, and its rows share the component; a null id
    is used only where a component has no other. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ready(spark)
    with scratch(spark, "rotation-codes") as tables:
        every = vectors.select(F.col(id_column).cast("long").alias("vec"), F.col(vector_column).alias("v"))
        scaled = every.where(usable_vector("v")).mapInPandas(_unit, "vec long, unit array<double>")
        # equal vectors at once; a hash of the components stands for the group, as ids may repeat or be null
        groups = scaled.groupBy("unit").agg(F.count("*").alias("weight"))
        groups = tables.store(groups.withColumn("id", F.xxhash64(F.size("unit"), "unit")), "groups")
        members = scaled.select("vec", "unit").join(groups, "unit").select("vec", "id", "weight")
        members = tables.store(members, "members")
        linked = _linked(groups, tables, cosine, miss, sigmas, block)
        ties = linked.select(F.col("id").alias("a"), F.col("root").alias("b"))
        # rows that repeat an id share its component
        same_id = members.groupBy("vec").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("vec is not null and b < last")
        again = members.join(same_id, "vec").select(F.col("id").alias("a"), "b")
        parts = components(ties.union(again), tables)
        counted = linked.groupBy("id").agg(F.sum("links").alias("links"))
        placed = (
            members.join(counted, "id", "left")
            .join(parts.withColumnRenamed("node", "id"), "id", "left")
            .select(
                "vec",
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
                F.coalesce("component", "id").alias("component"),
            )
        )
        placed = tables.store(placed, "placed")
        smallest = placed.groupBy("component").agg(F.min("vec").alias("component_id"))
        per_vector = placed.join(smallest, "component").select("vec", "n_links", "component_id")
        rest = every.where(~usable_vector("v")).select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
        done = per_vector.unionByName(rest).withColumnRenamed("vec", id_column)
        return tables.store(done.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))), "result")


def _linked(groups: DataFrame, tables: Scratch, cosine: float, miss: float, sigmas: float, block: int) -> DataFrame:
    """(id, links, root), a row for each vector and pair of blocks in which it has links."""
    count = groups.count()
    bits, n_tables = plan_tables(count, cosine, miss)
    keyed = tables.store(
        groups.select("id", "unit").mapInPandas(_keyed(bits, n_tables), "id long, dim int, keys array<long>"), "keyed"
    )
    met = keyed.select("id", "dim", F.posexplode("keys").alias("tab", "key"))
    sizes = met.groupBy("dim", "tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    placed = met.join(sizes, ["dim", "tab", "key"])
    dealt = deal_blocks(placed, ["dim", "tab", "key"], "id", "n", block).drop("n")
    dealt = tables.store(dealt, "dealt")
    # many small buckets share a task; a large one brings at most two blocks of rows
    tasks = max(1, math.ceil(dealt.count() / (2 * block)))
    full = dealt.join(keyed.select("id", "keys"), "id").join(groups, "id")
    out = full.groupBy(F.pmod(F.xxhash64("tab", "key", "p", "q"), F.lit(tasks)).alias("deal")).applyInPandas(
        _compare(cosine, sigmas), "id long, links long, root long"
    )
    return tables.store(out, "linked")
