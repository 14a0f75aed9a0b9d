"""Nearest neighbours by inner product: a join of matrix blocks with int8 tiles.

Queries and candidates are dealt into blocks, and every pair of a query block and a
candidate block is one task, so neither side has to fit anywhere as a whole. In a task

- both blocks are rounded to int8 with a scale per vector, and a tile of their integer
  products estimates the inner products. With q = a + d, where a is what the integers stand
  for, |q.c - a.b| <= |a||e| + |d||b| + |d||e|: the norms of the rounding errors are stored with
  the vectors, and the bound holds always, not with some probability;
- the k best lower bounds of a query give a score that it reaches for certain. Pairs whose
  upper bound is below it are dropped, the others are computed in double precision;
- a heap of k per query collects them.

The lists of a query from all candidate blocks meet in a second, small heap merge.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import ready, scratch, usable_vector


def _int8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Integers, scale, norm of what they stand for, norm of the rounding error."""
    scale = np.abs(x).max(axis=1) / 127
    whole = np.rint(x / scale[:, None])
    stands = whole * scale[:, None]
    return whole.astype(np.int8), scale, np.linalg.norm(stands, axis=1), np.linalg.norm(x - stands, axis=1)


def _levelled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector times a power of two that brings its greatest component to 0.5 to 1, and the exponent taken out."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -power[:, None]), power


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k highest scores, ties to the smaller id. What is no number comes last."""
    scores = np.where(np.isnan(scores), -np.inf, scores)
    return heapq.nsmallest(k, zip((-scores).tolist(), ids.tolist()))


def tile_search(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, tile: int = 256):
    """(query, candidate, score) of the k nearest candidates of this block for each query.

    Bounds are computed on levelled vectors, where nothing over- or underflows, and brought back to scale. They say nothing
    about pairs whose score may overflow.
    """
    (ql, qp), (cl, cp) = _levelled(q), _levelled(c)
    qi, qs, qn, qe = _int8(ql)
    ci, cs, cn, ce = _int8(cl)
    tiny = q.shape[1] * 5e-324
    cf = ci.astype(np.float32)
    out = []
    for at in range(0, len(q), tile):
        to = min(at + tile, len(q))
        # sums of int8 products are below 2^24 up to 1,000 components: float32 holds them exactly
        kind = np.float32 if q.shape[1] <= 1000 else np.float64
        whole = qi[at:to].astype(kind) @ cf.astype(kind, copy=False).T
        score = whole * qs[at:to, None] * cs[None, :]
        # the last term covers the rounding of this estimate and of the exact product itself
        slack = (
            qn[at:to, None] * ce + qe[at:to, None] * cn + qe[at:to, None] * ce
            + 1e-6 * (qn[at:to, None] + qe[at:to, None]) * (cn + ce)
        )
        own = qid[at:to, None] == cid[None, :]
        power = qp[at:to, None] + cp[None, :]
        with np.errstate(over="ignore"):
            low, high = np.ldexp(score - slack, power) - tiny, np.ldexp(score + slack, power) + tiny
        beyond = power > 1000 - q.shape[1].bit_length()  # a product or sum may overflow: computed exactly in any case
        low[own | beyond], high[beyond] = -np.inf, np.inf
        if len(c) > k:
            reached = np.partition(low, len(c) - k, axis=1)[:, len(c) - k]
        else:
            reached = np.full(to - at, -np.inf)
        near = ~own & (high >= reached[:, None])
        for i in range(to - at):
            js = np.flatnonzero(near[i])
            with np.errstate(over="ignore", invalid="ignore"):
                exact = np.einsum("ij,j->i", c[js], q[at + i])
            out += [(qid[at + i], j, -s) for s, j in _best(cid[js], exact, k)]
    return out


def _search(k: int):
    columns = ["query_id", "vec_id", "score"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["asks"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        x = np.stack(frame["v"].to_list())
        ids = frame["id"].to_numpy()
        return pd.DataFrame(tile_search(ids[asks], x[asks], ids[~asks], x[~asks], k), columns=columns)

    return run


def _merge(k: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for query, part in frame.groupby("query_id"):
            best = _best(part["vec_id"].to_numpy(), part["score"].to_numpy(), k)
            rows += [(query, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
        return pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])

    return run


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block: int = 8192,
) -> DataFrame:
    """The k nearest candidates of each query: query_id, rank, vec_id, score.

    Ties go to the smaller id; a query is never its own neighbour. Null, zero and non-finite
    vectors and null ids take no part. Finite components may be as large or small as doubles are; a score that
    overflows is infinite, or last if it is no number. Rows that repeat an id count as separate candidates.
    Only vectors of one dimension are compared. Empty tables give an empty result.
    """
    spark = candidates.sparkSession
    ready(spark)

    def clean(df):
        picked = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
        return picked.where(usable_vector("v") & F.col("id").isNotNull()).select(
            "id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim")
        )

    with scratch(spark, "block-knn") as tables:
        asked, rows = tables.store(clean(queries), "asked"), tables.store(clean(candidates), "rows")
        q_blocks = max(1, math.ceil(asked.count() / block))
        c_blocks = max(1, math.ceil(rows.count() / block))

        def dealt(df, asks, own, n_own, other, n_other):
            return df.select(
                "id", "v", "dim", F.lit(asks).alias("asks"),
                F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            )

        sides = dealt(asked, True, "qb", q_blocks, "cb", c_blocks).unionByName(
            dealt(rows, False, "cb", c_blocks, "qb", q_blocks)
        )
        part = sides.groupBy("dim", "qb", "cb").applyInPandas(_search(k), "query_id long, vec_id long, score double")
        part = tables.store(part, "part")
        merged = part.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(64 * q_blocks)).alias("deal")).applyInPandas(
            _merge(k), "query_id long, rank int, vec_id long, score double"
        )
        return tables.store(merged, "result")
