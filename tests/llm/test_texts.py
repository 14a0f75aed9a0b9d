"""Personal data, toxicity, secrets and mixing on small texts."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmarts.llm import pii_crf, queries, secret_ledger, target_mixing, toxic_segments
from gridmarts.llm.common import new_folder, scratch

# --- personal data -----------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The base rules as they are written."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for rank, rule, least, most in ((2, CARD, 12, 19), (3, PHONE, 9, 15)):
        for m in rule.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (rank == 3 or pii_crf.luhn(digits)):
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_rules():
    rng = random.Random(8)
    bits = ["4111111111111111", "4111 1111 1111 1111", "a@b.c", "1.2.3.4", "256.", "+49 30 1234567", "é", "%_"]
    for _ in range(5_000):
        text = "".join(
            rng.choice("a.@-+ 1290b()") if rng.random() < 0.8 else rng.choice(bits) for _ in range(rng.randint(0, 18))
        )
        assert pii_crf.base_spans(text) == plain_spans(text), text
    assert pii_crf.base_spans("1" * 200_000 + "." + "@" * 50_000 + "a" * 200_000) == []


@pytest.fixture(scope="module")
def field():
    return pii_crf.train(pii_crf.labelled_rows())


def test_the_field_learns_its_table(field):
    right = wrong = 0
    fresh = pii_crf.labelled_rows(seed=99)  # other digits
    for text, spans in zip(fresh["text"], fresh["spans"]):
        labels = field.decode([pii_crf.stretch_features(text.split())])[0][0]
        for (a, b), got in zip((pii_crf.core(text, m.span()) for m in pii_crf.TOKEN.finditer(text)), labels):
            want = next((k for lo, hi, k in spans if a < hi and b > lo), "O")
            right, wrong = right + (pii_crf.LABELS[got] == want), wrong + (pii_crf.LABELS[got] != want)
    assert right / (right + wrong) > 0.97


def test_viterbi_and_posteriors_equal_enumeration(field):
    rng = np.random.default_rng(2)
    k = len(pii_crf.LABELS)
    for size in (1, 2, 4):
        scores, moves = rng.normal(size=(1, size, k)), rng.normal(size=(k, k))
        paths = np.array(np.meshgrid(*[range(k)] * size, indexing="ij")).reshape(size, -1).T
        totals = scores[0, np.arange(size), paths].sum(axis=1) + moves[paths[:, :-1], paths[:, 1:]].sum(axis=1)
        model = pii_crf.Crf({}, np.zeros((1, k)), moves)
        model.emissions = lambda rows: (scores, np.array([size]))
        labels, sure = model.decode([None])
        assert labels[0].tolist() == paths[totals.argmax()].tolist()
        chance = np.exp(totals - totals.max())
        chance /= chance.sum()
        for t in range(size):
            assert math.isclose(sure[0][t], chance[paths[:, t] == labels[0][t]].sum(), rel_tol=1e-9)


def added(field, texts):
    base = [pii_crf.base_spans(t) for t in texts]
    return pii_crf.added_spans(texts, base, pii_crf.Scorer(field), 0.6)


def test_added_spans(field):
    texts = ["call (456) 555-2186, thanks", "max (at) firma.de it is", "in 1999, 200 people", "Version 2.0. See there", ""]
    texts += ["ring 02 99 12 34 56 now", "so jo(at)host.org is", "x ann at web dot com y", "look at the dot com boom"]
    found = [[t[a:b] for a, _, b in x] for t, x in zip(texts, added(field, texts))]
    assert found == [
        ["(456) 555-2186"], ["max (at) firma.de"], [], [], [], ["02 99 12 34 56"], ["jo(at)host.org"], ["ann at web dot com"], [],
    ]


# sentences that the labelled table does not have
HELD_OUT = (
    "you can phone {phone:###-###-####} before noon",
    "please dial {phone:(###) ###-####} or",
    "their number: {phone:0# ## ## ## ##}.",
    "ring {phone:###.###.####} tonight",
    "contact {email:maria at posteo dot net} about it",
    "drop a line to {email:k.meyer(at)uni-ulm.de}, we",
    "reply to {email:sales [at] shop [dot] com} soon",
    "(see {email:lee(at)acme.org})",
    "to order, fax {phone:(###)###-####} any day",
    "kindly write {email:office (at) mills.net} first",
    "we met at the dot of noon in June ####",
    "at ##:## the dot on row # turned red",
    "chapter ## has ### pages and #### words",
    "the price rose ##.## at ## percent",
    "born ##/##/####, ID ###-##-####",
    "Version #.##.# at release ####",
    "A.B. Smith at Acme. Com is short",
)


def test_the_field_adds_what_the_base_rules_miss(field):
    rng, hit, extra, missed = random.Random(5), 0, 0, 0
    for template in HELD_OUT * 20:
        text, want = "", set()
        for part in re.split(r"(\{\w+:[^}]*\})", template):
            kind, _, body = part[1:-1].partition(":") if part.startswith("{") else ("", "", part)
            body = re.sub("#", lambda m: rng.choice("123456789"), body)
            if kind:
                want.add((len(text), len(pii_crf.KINDS) + pii_crf.KINDS.index(kind), len(text) + len(body)))
            text += body
        assert not {(a, r + len(pii_crf.KINDS), b) for a, r, b in pii_crf.base_spans(text)} & want
        got = set(added(field, [text])[0])
        hit, extra, missed = hit + len(got & want), extra + len(got - want), missed + len(want - got)
    assert hit / (hit + missed) >= 0.9 and hit / (hit + extra) >= 0.95, (hit, extra, missed)


def test_windows_give_the_labels_of_whole_texts(field):
    """Long texts are decoded in windows with context; texts of one slice do not see each other."""
    rng = random.Random(3)
    bits = ["call", "(456) 555-2186", "ann at web dot com", "max (at) firma.de", "200", "people", "the", "02 99 12 34 56", "Version", "2.0."]
    texts = [" ".join(rng.choices(bits, k=k)) for k in (0, 1, 60, 700, 5)]
    scorer = pii_crf.Scorer(field)
    for text, got in zip(texts, scorer.labels([t.split() for t in texts])[0]):
        if text:
            assert got.tolist() == field.decode([pii_crf.stretch_features(text.split())])[0][0].tolist()
        else:
            assert len(got) == 0


def test_personal_data_query(spark, tmp_path):
    """The contract columns against the rules as they are written."""
    texts = ["a@b.cd +49 30 1234567, 1.2.3.4", None, "", "4111 1111 1111 1111", "so jo(at)host.org is", "x" * 9000 + " 9.9.9.9 " + "y" * 9000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op2_pii_crf(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, text in enumerate(texts):
        want = plain_spans(text or "")
        written = ",".join(f"{pii_crf.KINDS[r]}:{a}:{b}" for a, r, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        counts = [got[i][f"n_{k}"] for k in pii_crf.KINDS]
        assert counts == [sum(r == rank for _, r, _ in want) for rank in range(4)]
        assert [x for x in got[i]["spans"].split(",") if x and not x.startswith("crf_")] == [x for x in written.split(",") if x]
    assert got[4]["spans"] == "crf_email:3:17" and got[4]["n_spans"] == 1


def test_personal_data_of_awkward_rows(awkward, nothing):
    got = pii_crf.find_personal_data(awkward)
    assert got.columns == [*awkward.columns, "pii_spans"] and got.count() == awkward.count()
    assert got.where("size(pii_spans) > 0").count() == 0
    assert pii_crf.find_personal_data(nothing).count() == 0


# --- toxicity ----------------------------------------------------------------------


def brute_segments(scores):
    """Recursively: the best segment (the first, shortest), then left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[2] + 1e-9):
                best = (i, j + 1, total)
    if not best:
        return []
    i, j, s = best
    right = [(a + j, b + j, t) for a, b, t in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j, s), *right]


def test_maximal_segments_equal_the_recursive_definition():
    rng = random.Random(5)
    for _ in range(400):
        # distinct sums, so that there are no ties
        scores = [rng.choice([-3, -1, -0.5, 1, 2, 4]) + rng.random() * 1e-3 for _ in range(rng.randint(0, 25))]
        got = [(i, j) for i, j, _ in toxic_segments.maximal_segments(scores)]
        assert got == [(i, j) for i, j, _ in brute_segments(scores)]


def test_many_scores_take_linear_time():
    rng = random.Random(1)
    scores = [rng.uniform(-1, 1) for _ in range(300_000)] + [1.0] * 100_000 + [-1.0, 1.0] * 100_000
    assert sum(s for _, _, s in toxic_segments.maximal_segments(scores)) > 0


def test_held_out_toxic_texts_are_found(spark, words, awkward, nothing):
    bad = ["vileword", "awfulone", "nastything", "grimmeraa", "grimmerbb", "grimmercc", "grimmerdd"]
    rng, rows = random.Random(3), []
    for i in range(1_200):
        own = words(i, 60).split(" ")
        toxic = i % 5 == 0
        for _ in range(4 * toxic):
            own.insert(rng.randrange(60), rng.choice(bad))
        rows.append((i, " ".join(own), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = toxic_segments.learn_from_tables(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    held = toxic_segments.scored(docs, model).where(toxic_segments.held_out())
    wrong = held.where("(toxic_score >= 0.3) <> (toxic = 1)").count()
    assert wrong <= 0.03 * held.count()
    # a new word with a known beginning, found where it stands
    spans = model.segments("plain words here then grimmerzz vileword and again plain words")
    assert [(a, b) for a, b, *_ in spans] == [(22, 40)]
    got = toxic_segments.scored(awkward, model)
    assert got.count() == awkward.count() and got.where("toxic_score between 0 and 1").count() == awkward.count()
    assert toxic_segments.scored(nothing, model).count() == 0
    none = toxic_segments.learn_from_tables(nothing, nothing.selectExpr("doc_id", "1 as toxic"))
    assert none.weights == {} and 0 <= none.probability(np.zeros(1))[0] <= 1


# --- secrets -----------------------------------------------------------------------

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_secrets(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secret_texts():
    rng = random.Random(6)
    bits = ["password", "PassWd", "token=", ": ", '"', "'", " ", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef" * 2,
            "secret=token: abcdefgh", "ſecret=abcdefg", "toKen=abcdefg", "😀", "é", "\n", "api_key", "APIKEY=", "x1y2z3", "="]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(600)]


def test_base_secrets_are_those_of_the_rules(spark):
    texts = secret_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    found = secret_ledger.find_secrets(docs, new_folder(spark, "ledger"), "path", rules=secret_ledger.BASE_RULES)
    clean = secret_ledger.redacted(F.col("text"), F.col("secret_spans"))
    for r in found.withColumn("clean", clean).collect():
        assert [tuple(s) for s in r["secret_spans"]] == plain_secrets(texts[r["path"]]), texts[r["path"]]
        at, out = 0, ""
        for a, _, b, _ in plain_secrets(texts[r["path"]]):
            if a >= at:
                out += texts[r["path"]][at:a] + "[SECRET]"
            at = max(at, b)
        assert r["clean"] == out + texts[r["path"]][at:]


def test_secrets_query(spark, tmp_path):
    """The contract columns against the rules as they are written, null and empty texts among them."""
    texts = [None, "", *secret_texts()[:400], "AKIA" + "Z" * 16, "x" * 9000 + " token=abcdef"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op5_secret_ledger(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(len(texts)))
    kinds = [r.kind for r in secret_ledger.BASE_RULES]
    for i, text in enumerate(texts):
        want = plain_secrets(text or "")
        written = [f"{kind}:{a}:{b}" for a, _, b, kind in want]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(w[3] == k for w in want) for k in kinds]
        spans = [x for x in got[i]["spans"].split(",") if x.split(":")[0] in kinds]
        assert spans == [x for x in written if x]


def test_only_unseen_pairs_are_scanned(spark, awkward, nothing):
    ledger = new_folder(spark, "ledger")
    old, new = "password=abcdef1", "token: 123456789"
    first = spark.createDataFrame([("a@1", old), ("b@1", old), ("c@1", "nothing")], "path string, text string")
    later = spark.createDataFrame([("a@2", new), ("moved@2", old), ("a@1", old)], "path string, text string")
    rules = secret_ledger.BASE_RULES
    secret_ledger.find_secrets(first, ledger, "path", rules=rules).count()
    assert spark.read.parquet(ledger).count() == 2 * len(rules)
    got = secret_ledger.find_secrets(later, ledger, "path", rules=rules).collect()
    assert {r["path"]: len(r["secret_spans"]) for r in got} == {"a@2": 1, "moved@2": 1, "a@1": 1}
    assert spark.read.parquet(ledger).count() == 3 * len(rules)
    # a new version of one rule is tried on what it has not seen, alone
    changed = (secret_ledger.Rule("hex", "[0-9a-f]{99,}", version=2), *rules[:2])
    secret_ledger.find_secrets(later, ledger, "path", rules=changed).count()
    assert spark.read.parquet(ledger).where("kind = 'hex' and version = 2").count() == 2
    assert spark.read.parquet(ledger).count() == 3 * len(rules) + 2
    found = secret_ledger.find_secrets(awkward, new_folder(spark, "ledger"), "doc_id")
    assert found.count() == awkward.count() and found.where("size(secret_spans) > 0").count() == 0
    assert secret_ledger.find_secrets(nothing, new_folder(spark, "ledger"), "doc_id").count() == 0


def test_no_python_on_the_main_path(spark, awkward):
    plan = secret_ledger.find_secrets(awkward, new_folder(spark, "ledger"), "doc_id")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert hashlib.sha256(b"").digest() == bytes(awkward.select(secret_ledger.blob_of(F.lit(""))).first()[0])


# --- mixing ------------------------------------------------------------------------


def test_rates_meet_the_targets(spark, words):
    rng, rows = random.Random(2), []
    for i in range(300):
        domain = "ab"[i % 4 == 0]
        own = [f"{domain}{w}" for w in words(i, 40).split(" ")]
        if i % 10 == 0:  # half of each
            own = own[:20] + [f"{'ba'[domain == 'b']}{w}" for w in words(i + 1, 20).split(" ")]
        rows.append((i, " ".join(own), domain if rng.random() < 0.5 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = target_mixing.bounded_labels(docs)
    mixed = target_mixing.mixed(docs, labelled, {"a": 0.5, "b": 0.5}).toPandas()
    p = np.stack(mixed["posteriors"].to_list())
    assert np.allclose(p.sum(axis=1), 1) and (mixed["rate"] >= 0).all()
    totals = (mixed["rate"].to_numpy() * mixed["n_tokens"].to_numpy()) @ p
    assert np.allclose(totals / totals.sum(), 0.5, atol=2e-3)
    assert abs(totals.sum() - mixed["n_tokens"].sum()) < 0.01 * totals.sum()
    half = mixed.set_index("doc_id").loc[range(0, 300, 10)]
    assert np.stack(half["posteriors"].to_list()).max(axis=1).mean() < 0.97
    kept = target_mixing.mixed(docs, labelled, {"a": 0.5, "b": 0.5}, lowest=1.0, highest=4.0).toPandas()
    assert (kept["rate"] >= 1).all() and (kept["copies"] >= 1).all()


def test_rates_equal_plain_projected_gradient(spark):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([0.5, 0.5, 0.5], size=40)
    n = rng.integers(1, 200, size=40)
    rows = [(int(a), 1, b.tolist()) for a, b in zip(n, p)]
    members = spark.createDataFrame(rows, "n long, weight long, p array<double>")
    with scratch(spark, "test") as tables:
        got = target_mixing.fit_rates(members, [0.6, 0.3, 0.1], tables, highest=3.0, close=1e-6, steps=25).toPandas()
    rate, sizes = np.ones(40), n @ p
    goal = n.sum() * np.array([0.6, 0.3, 0.1])
    for _ in range(25):
        now = (rate * n) @ p
        if np.abs(now - goal).max() <= 1e-6 * n.sum():
            break
        rate = np.clip(rate - p @ ((now - goal) / sizes), 0, 3)
    assert np.allclose(np.sort(got["rate"]), np.sort(rate), atol=1e-9)


SCARCE = [(980, 100), (20, 100)]  # documents of a domain, tokens of each


def pure(spark, domains, soft=()):
    rows = [(n, 1, [float(i == k) for i in range(len(domains))]) for k, (m, n) in enumerate(domains) for _ in range(m)]
    return spark.createDataFrame([*rows, *soft], "n long, weight long, p array<double>")


@pytest.mark.parametrize("lowest", [0.0, 1.0])
def test_scarce_domains_reach_their_targets(spark, lowest):
    # the second domain has 2% of the tokens and needs rates of 10 and 12.25; some texts are of both
    soft = [(100, 1, [0.5, 0.5])] * 10
    members = pure(spark, SCARCE, soft)
    with scratch(spark, "test") as tables:
        got = target_mixing.fit_rates(members, [0.8, 0.2], tables, lowest=lowest).toPandas()
    totals = (got["rate"].to_numpy() * got["n"].to_numpy()) @ np.stack(got["p"].to_list())
    assert np.allclose(totals / totals.sum(), [0.8, 0.2], atol=2e-3)
    assert got["rate"].min() >= lowest and got["rate"].max() > 8


def test_slow_descent_goes_on_until_targets_are_met(spark):
    members = spark.createDataFrame([(100, 1, [0.65, 0.35]), (100, 1, [0.35, 0.65])], "n long, weight long, p array<double>")
    with scratch(spark, "test") as tables:
        got = target_mixing.fit_rates(members, [0.6, 0.4], tables, close=1e-4).toPandas()
    totals = (got["rate"].to_numpy() * 100) @ np.stack(got["p"].to_list())
    assert np.allclose(totals / 200, [0.6, 0.4], atol=1e-4)


def test_misses_are_told(spark):
    with scratch(spark, "test") as tables:
        with pytest.raises(ValueError, match="targets are missed"):
            target_mixing.fit_rates(pure(spark, [(10, 100), (0, 0)]), [0.8, 0.2], tables)
        with pytest.warns(UserWarning, match="targets are missed"):
            got = target_mixing.fit_rates(pure(spark, SCARCE), [0.8, 0.2], tables, highest=8.0)
        assert got.agg(F.max("rate")).first()[0] == 8.0


def test_mixing_of_awkward_rows(awkward, nothing, spark):
    labelled = spark.createDataFrame([("short text one", "a"), (None, "b"), ("other words", None)], "text string, domain string")
    got = target_mixing.mixed(awkward, labelled, {"a": 1.0, "b": 1.0})
    assert got.count() == awkward.count() and got.where("rate is null or copies is null").count() == 0
    assert target_mixing.mixed(nothing, labelled, {"a": 1.0, "b": 1.0}).count() == 0
    assert target_mixing.mixed(awkward, labelled.limit(0), {"a": 1.0}).count() == awkward.count()
