"""Stages of the corpus pipeline on small tables."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from gridmarts.llm import target_mixing
from gridmarts.llm.common import Scratch

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def test_clashing_and_null_ids_lose_only_near_duplicates(spark, words):
    a, b, c, d = (words(seed, 60) for seed in (11, 12, 13, 14))
    rows = [
        (1, a), (5, b), (5, a),  # an id that clashes: its second text is a copy of 1
        (5, c), (None, c), (None, c + " more"),  # copies with null ids
        (None, d), (None, d), (7, d.upper() + " x"),
        (8, b + " y"), (9, None), (9, None), (9, ""), (None, None), (None, "  "), (None, "  "),
    ]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], DOCUMENTS)
    got = corpus_pipeline.minhash(spark, docs, "")
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    kept = [(1, a), (5, b), (5, c), (7, d.upper() + " x")]
    kept += [(9, None), (9, None), (9, ""), (None, None), (None, "  "), (None, "  ")]  # no words
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(kept)
    # only null ids: one copy stays, and nothing is left over of an empty table
    only = docs.where("doc_id is null and length(text) > 9")
    assert corpus_pipeline.minhash(spark, only, "").count() == 2


def test_run_over_a_corpus_that_lacks_languages(spark, words, tmp_path):
    """All stages, in which two of the four target languages are absent and some rows hold nothing."""
    good = {f: words(s, 400).split() for f, s in (("en", 31), ("de", 32))}
    rows, labels = [], []
    for i in range(80):
        lang = ("en", "de")[i % 2]
        text = " ".join(random.Random(i).choices(good[lang], k=60))
        if i % 8 == 0:
            text += " vile filth scum vile filth scum rotten vile"
        rows.append((i, text, lang))
        labels.append((i, int(i % 8 == 0)))
    rows += [(100, rows[3][1], "de"), (101, rows[3][1].upper(), "de"), (102, None, None), (103, "", "en")]
    rows.append((104, words(33, 40) + " password=Abcdef123456 " + words(34, 40), "en"))
    docs = spark.createDataFrame([(i, t, g, "x", len(t or "")) for i, t, g in rows], DOCUMENTS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    with pytest.warns(UserWarning, match="'es', 'fr'"):
        pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    kept = set(pieces["doc_id"])
    assert {100, 101} & kept == set() and {102, 103, 104} <= kept
    assert {i for i in range(80) if i % 8} <= kept
    # places in a sequence follow one another without gaps, and none is too long
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 2048


def test_mixing_of_absent_languages_and_clashing_names(spark, words):
    docs = spark.createDataFrame([(i, words(i % 2, 30), ("en", "de")[i % 2], i) for i in range(20)], "doc_id long, text string, lang string, _node int")
    with pytest.warns(UserWarning, match="no labelled row"):
        got = target_mixing.mixed(docs, target_mixing.bounded_labels(docs), {"de": 0.3, "en": 0.3, "fr": 0.4})
    rows = got.collect()
    assert [r["_node"] for r in sorted(rows)] == list(range(20))
    assert all(r["posteriors"][2] == 0 and abs(sum(r["posteriors"]) - 1) < 1e-9 for r in rows)


def test_mixing_of_an_empty_table(spark):
    assert corpus_pipeline.mixing(spark, spark.createDataFrame([], DOCUMENTS), "").count() == 0


def broadcast_unmeasured(plan):
    """True if a plan broadcasts what no shuffle has measured, as Spark then goes by the size of files."""
    lines = plan.splitlines()
    depths = [re.search(r"[A-Za-z(*]", x).start() if re.search("[A-Za-z]", x) else 0 for x in lines]
    for i, depth in enumerate(depths):
        if "BroadcastExchange" in lines[i]:
            below = itertools.takewhile(lambda k: depths[k] > depth, range(i + 1, len(lines)))
            if not any("Exchange hashpartitioning" in lines[k] for k in below):
                return True
    return False


def test_tables_with_a_row_for_each_document_are_not_broadcast(spark, words, monkeypatch):
    """Their files may be far smaller than their rows, as those of near copies are, and the driver has to hold them."""
    plans = []

    def physical(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def store(self, df, name, plain=Scratch.store):
        plans.append((name, physical(df)))
        return plain(self, df, name)

    monkeypatch.setattr(Scratch, "store", store)
    texts = [words(i % 30, 80) + f" copy {i}" for i in range(120)]
    docs = spark.createDataFrame([(i, t, ("en", "de", "es", "fr")[i % 30 % 4], "x", len(t)) for i, t in enumerate(texts)], DOCUMENTS)
    # of the stages named here only bounded tables may be broadcast: rules, lexicon and chosen ids, which are not looked at
    stages = {"minhash": None, "secrets": set(), "mixing": {"rates"}}
    for stage, looked_at in stages.items():
        plans.clear()
        out = getattr(corpus_pipeline, stage)(spark, docs, "")
        plans.append(("returned", physical(out)))
        found = [(n, p) for n, p in plans if looked_at is None or n in {*looked_at, "returned"}]
        assert any("Join" in p for _, p in found)
        assert [n for n, p in found if broadcast_unmeasured(p)] == [], stage
        if stage == "minhash":
            assert {n for n, _ in found} >= {"placed", "texts", "tried", "found", "where", "dealt", "forest", "stars1", "rows", "result"}
            assert out.count() == 30  # one of each group of four


def test_labelled_texts_without_words_teach_nothing(spark, words, tmp_path):
    """Null and empty texts, and those without letters, of either label; they stay, as they have no toxic passage."""
    rows = [(i, words(i, 30) + (" vile filth scum rotten vile filth" if i % 4 == 0 else "")) for i in range(40)]
    blank = [(100, None), (101, None), (102, ""), (103, " \n"), (104, "2024 10-3 !?"), (105, "77 88 99")]
    table = lambda some: spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in some], DOCUMENTS)
    labels = [(i, int(i % 4 == 0)) for i in range(40)]

    def kept(labels, some, at):
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/{at}/labels.parquet")
        return {r["doc_id"] for r in corpus_pipeline.toxicity(spark, table(some), f"{tmp_path}/{at}").collect()}

    got = kept(labels + [(i, i % 2) for i, _ in blank], rows + blank, "with")
    assert {i for i, _ in blank} <= got
    assert got - {i for i, _ in blank} == kept(labels, rows, "without")
    # no text with words at all: they are scored alike
    assert kept([(i, i % 2) for i, _ in blank], blank, "only") in (set(), {i for i, _ in blank})
