"""Near duplicates and repeated passages among documents, against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from gridmarts.llm import minmax_hash, suffix_dedup
from gridmarts.llm.common import Scratch, scratch, whole_text
from gridmarts.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(sets):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_shingle_sets_are_those_of_the_texts():
    texts = ["", " ", "A b", "a  B", "a b c d e", "a b c d e f", "a b c d e a b c d e", "ß É \x1c x\x85y z q", "b a"]
    sets = [set(s.tolist()) for s in shingle_sets(texts)]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


def near_copies(words):
    """Groups with changed words, a chain, a group of many copies, and texts that share a passage."""
    rng, texts = random.Random(4), []
    for g in range(6):
        base = words(g, 60).split(" ")
        for k in range(12):
            own = list(base)
            for _ in range(k // 3):
                own[rng.randrange(60)] = f"w{rng.randrange(99)}"
            texts.append(" ".join(own))
    chain = words(77, 80).split(" ")
    for k in range(10):
        chain[5 * k] = f"link{k}"
        texts.append(" ".join(chain))
    passage = words(99, 30)
    texts += [f"{words(200 + k, 25)} {passage}" for k in range(30)]
    return texts + [texts[3]] * 20


@pytest.mark.parametrize("block", [2048, 8])
def test_groups_equal_brute_force(spark, words, block):
    texts = near_copies(words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in minmax_hash.near_duplicates(docs, block=block).collect())
    sets = [shingles(t) for t in texts]
    expected = components(sets)
    assert got == [(i, len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, expected))]


def test_awkward_rows(awkward, nothing, rows):
    got = minmax_hash.near_duplicates(awkward).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert len(got) == awkward.count()
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert [x[1:] for x in by[5] + by[6]] == [(4, False)] * 3 and by[4][0][1:] == (4, True)
    assert by[7] == [(1, 7, True)] and by[8] == [(1, 7, False)]
    assert by[10][0][1] == 9
    assert minmax_hash.near_duplicates(nothing).count() == 0


def covered(texts, length):
    """Per text, which bytes are in a string of that length that starts at two places."""
    raw, seen, where = [(t or "").encode() for t in texts], {}, []
    for i, b in enumerate(raw):
        for x in range(len(b) - length + 1):
            seen.setdefault(b[x : x + length], []).append((i, x))
    out = [np.zeros(len(b), dtype=bool) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, x in places:
                out[i][x : x + length] = True
    return raw, out


def passages(words):
    rng = random.Random(9)
    shared = [words(300 + k, 30) for k in range(4)]
    texts = ["", "aaa", "a" * 900, "ab" * 300, shared[0], "ß" * 150 + shared[1], words(5, 100)]
    for k in range(40):
        parts = [words(400 + k, rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            lo = rng.randint(0, 40)
            parts += [s[lo : lo + rng.randint(60, 160)], words(900 + rng.randrange(999), rng.randint(1, 20))]
        texts.append(rng.choice(["", " "]).join(parts))
    return texts + texts[10:14]


@pytest.mark.parametrize("length,anchor,cell", [(100, 32, 7), (60, 20, 20), (400, 64, 20)])
def test_removed_bytes_equal_brute_force(spark, words, length, anchor, cell):
    texts = passages(words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = suffix_dedup.with_repeated(docs, length=length, anchor=anchor, cell=cell)
    d = suffix_dedup.digest(whole_text(), F.col("repeated"))
    got = {r["doc_id"]: tuple(r["d"]) for r in found.select("doc_id", d.alias("d")).collect()}
    raw, out = covered(texts, length)
    for i, (b, gone) in enumerate(zip(raw, out)):
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert got[i] == (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()), i


def test_awkward_rows_of_passages(awkward, nothing):
    found = suffix_dedup.with_repeated(awkward)
    assert found.columns == awkward.columns
    kept = found.select("doc_id", suffix_dedup.kept_bytes(whole_text(), F.col("repeated")).alias("k"), "repeated").collect()
    by = {r["doc_id"]: r for r in kept}
    assert len(kept) == awkward.count()
    assert by[1]["repeated"] == [] and by[2]["k"] == b"" and by[3]["k"] == b" \t\n"
    assert by[6]["k"] == b"" and len(by[4]["repeated"]) == 2  # before and after the changed word
    assert suffix_dedup.with_repeated(nothing).count() == 0


def test_order_of_the_multikey_sort():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 4, size=(20_000, 3)).astype(np.uint64)
    tokens[:9_000] = 2
    ranked = tokens[suffix_dedup.multikey_order(tokens, small=16)]
    assert (ranked == tokens[np.lexsort(tokens.T[::-1])]).all()


def test_splitters_come_from_the_whole_table(spark, words):
    # the table begins with copies of one text, more than are sampled
    rows = [(i, words(0, 80)) for i in range(300)] + [(300 + i, words(i, 80)) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc long, text string").coalesce(1)
    splitters = suffix_dedup._sampled_splitters(docs, 100, 20, 64, 40)
    assert len(splitters) == 63 and splitters == sorted(set(splitters))
    own = {rows[0][1].encode()[i : i + 20] for i in range(len(rows[0][1]))}
    assert sum(s in own for s in splitters) < 16


def test_a_passage_of_all_documents_fills_no_bucket(words):
    line = words(1, 9) + " "
    texts = [words(100 + k, 20) + line * 30 for k in range(400)]
    frame = pd.DataFrame({"doc": np.arange(400) * 7_919, "text": texts})
    cuts = [bytes([c]) * 64 for c in b"dgjmpsv"]
    found = pd.concat(suffix_dedup._suffixes(400, 64, cuts)(iter([frame])))
    passed = found[found["lead"].isna()]
    assert passed["known"].all() and passed["gram"].value_counts().iloc[0] > 1_000  # one anchor in all of them
    n = passed["bucket"].value_counts()
    assert len(n) == 8 and n.max() < 1.5 * n.min()


def test_a_stretch_of_all_documents_fills_no_task(spark):
    """Rows of one frequent stretch are marked where they are; those that occur twice and once are told apart."""
    rows = spark.range(0, 24_000, numPartitions=8).selectExpr(
        "id as doc", "10L as lo", "20L as hi", "15L as s", "7L as gram",
        "case when id < 20000 then 1L when id < 22000 then id div 2 else id end as u1", "2L as u2",
    )
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        judged = suffix_dedup._judged(rows).select("doc", "all", F.spark_partition_id().alias("task")).toPandas()
        looked = suffix_dedup._to_look_at(suffix_dedup._judged(rows), ["gram"])
        places = sorted(r["doc"] for r in looked.select("doc").collect())
    finally:
        spark.conf.set(threshold, before)
    assert sorted(judged["doc"]) == list(range(24_000))
    assert sorted(judged["doc"][judged["all"].notna()]) == list(range(22_000))
    assert judged["task"].value_counts().max() < 6_000
    assert places[-2_000:] == list(range(22_000, 24_000)) and len(places) == 1 + 1_000 + 2_000


def test_frequent_stretches_equal_brute_force(spark, words, monkeypatch):
    """However few rows make a stretch frequent, the same bytes go."""
    texts = passages(words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    expected = [int(gone.sum()) for gone in covered(texts, 100)[1]]
    for least in (1, 3):
        monkeypatch.setattr(suffix_dedup, "FREQUENT", least, raising=False)
        found = suffix_dedup.with_repeated(docs, length=100, anchor=32, cell=7)
        got = {r["doc_id"]: sum(s["end"] - s["start"] for s in r["repeated"]) for r in found.collect()}
        assert [got[i] for i in range(len(texts))] == expected


def test_marks_are_joined_row_by_row(spark, words, monkeypatch):
    """No join of stretches returns more rows because more of them are frequent: each returns its rows once."""
    rows = spark.range(0, 3_000).selectExpr(
        "id as doc", "10L as lo", "20L as hi", "15L as s", "7L as gram", "if(id < 2000, 1L, id div 2) as u1", "2L as u2"
    )
    plans, store = {}, Scratch.store

    def noted(self, df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(self, df, name)

    monkeypatch.setattr(Scratch, "store", noted)
    texts = passages(words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    with monkeypatch.context() as few:
        few.setattr(suffix_dedup, "FREQUENT", 1)
        suffix_dedup.with_repeated(docs, length=100, anchor=32, cell=7)
    for name in ("wholes", "parts", "marked"):
        assert not any("LeftSemi" in p or "LeftAnti" in p for p in plans.get(name, [])), name
    assert plans["marked"] and all("Join LeftOuter" in p for p in plans["wholes"])
    with scratch(spark, "marks") as tables:
        kept = tables.store(rows, "rows")
        judged = tables.store(suffix_dedup._judged(kept, tables), "judged")
        assert judged.where("all").count() == judged.count() == judged.select("doc").distinct().count() == 3_000


def test_pairs_are_confirmed_on_few_characters_at_once(monkeypatch):
    """However long the texts of a batch are, arrays are made of a bounded part of them."""
    sizes, made = [], minmax_hash.shingle_sets
    monkeypatch.setattr(minmax_hash, "shingle_sets", lambda t, w: sizes.append(sum(map(len, t))) or made(t, w))
    pack = zstandard.ZstdCompressor()
    texts = [" ".join(f"w{i}" for i in range(20_000 + k)) for k in range(20)] + ["quite another text of a few words"]
    frame = pd.DataFrame({
        "hub": 0, "salt": 0, "node": range(len(texts)), "is_hub": [True] + [False] * 20,
        "packed": [pack.compress(t.encode()) for t in texts],
    })
    found = minmax_hash._confirm(75, 5)(frame)
    assert found.to_numpy().tolist() == [[k, 0] for k in range(1, 20)]
    assert max(sizes) <= minmax_hash.PIECE + max(map(len, texts))
