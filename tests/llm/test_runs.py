"""Periodic runs, source divergence and piece encoding against brute force and the library."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from acceptance.check import duckdb_views
from gridmarts.llm import merge_pieces, periodic_runs, queries, source_tree

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path(queries.PIECES)


def smallest_period(w):
    k, fail = 0, [0] * len(w)
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def all_runs(w, least=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n = rng.choice([0, 1, 11, 12, 13, 24, 60, 150])
    letters = [b"a", b"b", b"c", b"d", b"e", b"f"][: rng.choice([1, 2, 3, 6])]
    w = [rng.choice(letters) for _ in range(n)]
    kind = rng.randrange(4)
    if kind == 1:
        part = [rng.choice(letters) for _ in range(rng.randint(1, 20))]
        w = w + part * rng.randint(1, 6) + part[: rng.randint(0, len(part))] + w
    if kind == 2:
        w = [b"x%d" % i for i in range(n)]
        w = w + w + w[: n // 2]
    if kind == 3:
        a, b = [b"a"], [b"a", b"b"]
        for _ in range(rng.randint(2, 8)):
            a, b = b, b + a
        w = b
    return w


def test_runs_equal_every_lag_tried():
    rng = random.Random(8)
    for _ in range(60):
        many = [some_words(rng) for _ in range(12)]
        for w, found in zip(many, periodic_runs.runs_of(many)):
            assert [tuple(r) for r in found.tolist()] == all_runs(w), w


def test_long_periods_and_one_word_many_times():
    assert periodic_runs.runs_of([[b"a"] * 50_000])[0].tolist() == [[0, 50_000, 1]]
    once = [b"%d" % i for i in range(20_000)]
    assert periodic_runs.runs_of([once + once])[0].tolist() == [[0, 40_000, 20_000]]
    assert periodic_runs.runs_of([once + once[:-1] + [b"x"]])[0].tolist() == []


def test_splitting_leaves_runs_alone():
    w = [b"p", *([b"q", b"r"] * 8), b"s", *([b"t"] * 11), b"u", *([b"v"] * 12)]
    assert periodic_runs.runs_of([w])[0].tolist() == [[1, 16, 2], [30, 12, 1]]
    assert periodic_runs.collapsed(w, periodic_runs.runs_of([w])[0]) == "p q r s " + "t " * 11 + "u v"


def test_runs_of_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumn("runs", F.lit("mine")).withColumn("_run_result", F.lit(3))
    got = periodic_runs.with_runs(docs.withColumn("text", F.concat_ws(" ", "text", F.lit("z z z z z z\tz z z z z z"))))
    rows = got.collect()
    assert len(rows) == docs.count() and {r["_run_result"] for r in rows} == {3}
    for r in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", r["text"].encode())
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]][-1] == (len(words) - 12, 12, 1)
    plain = periodic_runs.with_runs(awkward).where("doc_id in (1, 2, 3)").collect()
    assert [(r["runs"], r["collapsed"]) for r in plain] == [([], "")] * 3
    assert periodic_runs.with_runs(nothing).count() == 0


def test_op11_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc, text in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        n, h = len(w), zlib.crc32(str(doc).encode())
        if n > 1_500:
            continue  # too slow by brute force
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = all_runs(w)
        gone = {i for s, long, q in runs for i in range(s + q, s + long)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        milli = 1000 * best[1] // best[2] if runs else None
        assert got[doc] == (len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_op12_equals_its_sql(spark):
    got = queries.op12_source_tree(spark, SMALL)
    expected = duckdb_views(SMALL).sql(queries.OP12_SQL)
    assert got.columns == expected.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected.fetchall())


def test_divergence_of_awkward_groups(spark, tmp_path):
    """Null languages and sources, no terms, odd letters, repeated rows, clashing names; small trees and many cuts."""
    import duckdb

    rng = random.Random(4)
    stems = ["É", "ÀB", "eins", "Zwei", "x", "drei1vier", "中文", "a_b"]
    rows = []
    for i in range(400):
        text = rng.choice([None, "", "12 34", *(" ".join(rng.choices(stems, k=rng.randint(1, 30))) for _ in range(9))])
        rows.append((i // 2, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None]), "p", "rank"))
    rows += [(900, "only here", "fr", "s1", "p", "rank"), (901, None, "fr", "s2", "p", "rank")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p string, rank string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = sorted(con.sql(queries.OP12_SQL).fetchall())
    assert sorted(tuple(r) for r in source_tree.divergence(docs).collect()) == expected
    tiny = source_tree.divergence(docs, most_entries=5, most_nodes=4, cuts=3)
    assert sorted(tuple(r) for r in tiny.collect()) == expected
    assert source_tree.divergence(docs.limit(0)).count() == 0


def test_tree_shares_paths():
    tree = source_tree.Tree()
    for path in ([("a", 5, 2), ("b", 7, 3)], [("a", 5, 2), ("b", 7, 3), ("c", 9, 4)], [("a", 6, 2), ("c", 9, 4)]):
        tree.insert(path, 2)
    assert tree.rows == [4, 4, 2, 2, 2]

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    def fix(p, p0, q, q0):
        return f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

    assert sorted(tree.corrections()) == [
        ("a", "b", 4 * fix(5, 2, 7, 3)), ("a", "c", 2 * fix(5, 2, 9, 4) + 2 * fix(6, 2, 9, 4)), ("b", "c", 2 * fix(7, 3, 9, 4)),
    ]


@pytest.fixture(scope="module")
def merger():
    with open(MODEL, "rb") as file:
        return merge_pieces.Merger(file.read(), most_characters=2_000)  # emptied now and then


def test_pieces_equal_the_library(merger):
    rng = random.Random(3)
    bits = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "中", "😀", "\x00", "<s>", "<0x0A>", "the", "ing", "▁▁▁", "",
            "x" * 50, "０", "ﬁ", "​", "�", "́", "1", ".", "Straße"]
    for _ in range(800):
        texts = ["".join(rng.choices(bits, k=rng.randint(0, 20))) for _ in range(5)]
        for text, (ids, decoded) in zip(texts, merger.encode(texts)):
            assert ids.tolist() == merger.library.encode(text), text
            assert decoded == merger.library.decode(ids.tolist()) == merger.decode(ids.tolist())
            assert merger.pieces(merger.library.normalize(text)) == ids.tolist()


def test_a_full_table_keeps_what_comes_often():
    """A chunk that came more than once is not worked out again, neither in a full table nor in a worker's next task."""
    with open(MODEL, "rb") as file:
        model = file.read()
    own, asked = merge_pieces.Merger(model, most_characters=400), []

    class Counting:
        def __getattr__(self, name):
            return getattr(own_library, name)

        def encode(self, texts, **more):
            asked.extend(texts)
            return own_library.encode(texts, **more)

    own_library, own.library = own.library, Counting()
    text = "again and again a word\x00 that comes \t often, Straße 😀"
    for k in range(40):
        whole = f"{text} {'x' * k} {text}"
        [(ids, decoded)] = own.encode([whole])
        assert ids.tolist() == own_library.encode(whole) and decoded == own_library.decode(ids.tolist())
        assert own.held <= 400 + len(whole)
    assert asked.count("often,") == 1 and asked.count("x" * 27) == 1 and len(own.chunks) < 60
    assert merge_pieces._merger_of(model) is merge_pieces._merger_of(bytes(bytearray(model)))


def test_texts_merged_together_equal_those_merged_alone(merger):
    rng = random.Random(8)
    for wide in (1, 2, 3, 9, 40):
        texts = ["".join(rng.choices("▁theinrsaé中😀", k=wide)) for _ in range(300)]
        for text, row in zip(texts, merger.merged_together(texts).tolist()):
            assert [s for s in row if s >= 0] == [merger._symbol(s) for s in merger.merged(text)], text


def test_any_ids_decode_as_in_the_library(merger):
    rng = random.Random(6)
    for _ in range(4_000):
        ids = rng.choices([*range(0, 300), *rng.sample(range(300, 32_000), 40), 28705, 259], k=rng.randint(0, 8))
        assert merger.decode(ids) == merger.library.decode(ids), ids


def test_a_library_that_differs_stops_the_job(merger):
    class Other:
        def __getattr__(self, name):
            return getattr(merger.library, name)

        def encode(self, texts, **_):
            return [[5] for _ in texts]

    with open(MODEL, "rb") as file:
        own = merge_pieces.Merger(file.read())
    own.library = Other()
    with pytest.raises(ValueError, match="differs"):
        own.encode(["a word"])


def test_encoded_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumn("decoded", F.lit("mine")).withColumn("_pieces", F.lit(3))
    rows = merge_pieces.compared(docs, MODEL).collect()
    assert len(rows) == docs.count() and all(r["same"] and r["_pieces"] == 3 for r in rows)
    assert [(r["piece_ids"], r["decoded"]) for r in rows if r["text"] is None] == [([], "")] * 2
    assert merge_pieces.encoded(nothing, MODEL).count() == 0


def test_op13_equals_the_library(spark):
    library = SentencePieceProcessor(model_file=MODEL)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_merge_pieces(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc, text in docs:
        ids = library.encode(text or "")
        sums = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        assert got[doc] == (len(ids), *sums)
