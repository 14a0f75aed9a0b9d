"""Near duplicates and neighbours among embeddings, against brute force."""

import numpy as np
import pytest
from pyspark.sql import types as T

from gridmarts.llm import block_knn, rotation_codes

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("unit", T.StringType()),  # a name used inside
    ]
)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    near = base[:20] + rng.normal(size=(20, 16)) * 0.05
    chain = [base[0] + k * 0.25 * base[1] for k in range(8)]
    group = base[3] + rng.normal(size=(40, 16)) * 0.03
    return np.concatenate([base, near, chain, group, base[:5], base[:5] * 7.5]).astype(np.float32)


def frame(spark, vectors, extra=()):
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


AWKWARD = [
    (1000, None, 0, "x"),
    (1001, [0.0] * 16, 0, "x"),
    (1002, [float("nan")] + [1.0] * 15, 0, "x"),
    (1003, [float("inf")] + [1.0] * 15, 0, "x"),
    (1004, [None] + [1.0] * 15, 0, "x"),
    (1005, [], 0, "x"),
    (1006, [1.0, 2.0], None, None),
]


@pytest.mark.parametrize("block", [2048, 16])
def test_links_and_components_equal_brute_force(spark, vectors, block):
    got = rotation_codes.near_duplicates(frame(spark, vectors, AWKWARD), block=block)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got.collect()}
    v = vectors.astype(float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(v))
    while True:
        low = np.array([min([label[i], *label[linked[i]]]) for i in range(len(v))])
        if (low == label).all():
            break
        label = low
    for i in range(len(v)):
        assert got[i] == (linked[i].sum(), label[i], i == label[i])
    for i, *_ in AWKWARD:
        assert got[i] == (0, i, True)


def test_no_vectors(spark):
    assert rotation_codes.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert block_knn.nearest(none, none).count() == 0


def test_enough_tables_for_the_miss_rate():
    bits, tables = rotation_codes.plan_tables(1_000_000, 0.95, 1e-5)
    meet = (1 - np.arccos(0.95) / np.pi) ** bits
    assert bits == 24 and (1 - meet) ** tables <= 1e-5


@pytest.mark.parametrize("block,k", [(8192, 20), (16, 5), (8192, 500)])
def test_neighbours_equal_brute_force(spark, vectors, block, k):
    rows = frame(spark, vectors, AWKWARD)
    got = block_knn.nearest(rows, rows.where("vec_id % 20 = 0"), k=k, block=block).collect()
    v = vectors.astype(float)
    for q in range(0, len(v), 20):
        scores = v @ v[q]
        order = sorted((j for j in range(len(v)) if j != q), key=lambda j: (-scores[j], j))[:k]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, len(order) + 1))
        assert np.allclose([m[2] for m in mine], scores[order], rtol=0, atol=1e-12)
        assert sorted(m[1] for m in mine) == sorted(order)
    assert not {r["query_id"] for r in got} & {1000, 1001, 1002, 1003, 1004, 1005}


def test_the_bound_of_int8_products_holds():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(50, 64)), rng.normal(size=(80, 64)) ** 3
    qi, qs, qn, qe = block_knn._int8(q)
    ci, cs, cn, ce = block_knn._int8(c)
    whole = qi.astype(int) @ ci.astype(int).T * qs[:, None] * cs
    slack = qn[:, None] * ce + qe[:, None] * cn + qe[:, None] * ce
    assert (np.abs(whole - q @ c.T) <= slack + 1e-12).all()


def test_repeated_and_null_ids(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(4, 16))
    near = base + rng.normal(size=(4, 16)) * 0.02
    rows = [
        (1, base[0]), (1, base[1]), (2, near[0]), (3, near[1]),  # one id, two vectors, a partner each
        (None, base[2]), (None, near[2]), (9, base[2] + near[2]),  # null ids and a partner with an id
        (None, base[3]), (None, near[3]),  # null ids only
        (4, rng.normal(size=5)), (4, rng.normal(size=7)),  # one id in two dimensions
    ]
    docs = spark.createDataFrame([(i, v.tolist(), 0, "x") for i, v in rows], SCHEMA)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rotation_codes.near_duplicates(docs).collect()), key=str)
    # all of 1, 2 and 3 are one component by the shared id
    assert got == sorted([
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False),
        (None, 2, 9, False), (None, 2, 9, False), (9, 2, 9, True),
        (None, 1, None, True), (None, 1, None, True), (4, 0, 4, True), (4, 0, 4, True),
    ], key=str)


def test_extreme_vectors_keep_their_neighbours():
    rng = np.random.default_rng(12)
    x = rng.standard_normal((70, 6))
    for at, factor in ((3, 1e160), (9, 1e200), (20, 1e-200), (33, 1e-310), (41, 1e155), (50, 1e300)):
        x[at] *= factor
    x[60] = [5e-324, 0, 0, 0, 0, 0]
    x[61] = [0, 1e308, 0, 0, 0, 1e-308]
    ids = np.arange(70)
    for query in (0, 3, 20, 33, 50, 60, 61):
        found = block_knn.tile_search(ids[[query]], x[[query]], ids, x, k=5, tile=16)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.einsum("ij,j->i", x, x[query])
        order = sorted((-s, i) for i, s in enumerate(np.where(np.isnan(scores), -np.inf, scores).tolist()) if i != query)
        assert [(j, s) for _, j, s in found] == [(i, -s) for s, i in order[:5]], query
