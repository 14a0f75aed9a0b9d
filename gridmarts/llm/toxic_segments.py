"""Toxic passages as maximum-scoring segments of token log-odds.

Learning, from labelled texts: every feature (a word, and its beginnings of ``PREFIXES``
letters, so that a new word formed from a known beginning still counts) is counted once per
text, by label. The chance that a text with the feature is toxic has a Dirichlet prior whose
mean is the chance of the next shorter beginning, down to the share of toxic texts; ``prior``
is its weight in texts. A word scores the log-odds of its longest known feature. Ordinary words have about the
log-odds of the share of toxic texts, so the expected score of ordinary text is negative. Of near copies
of a text only one is counted, so that words of a much copied text don't look toxic for its sake.

Search: one pass over a text's word scores finds all maximal scoring segments, each the
best passage of its surroundings and disjoint from the others, in time linear in the words.

Calibration: the best segment of n ordinary words follows an extreme-value law, and the
expected number of segments of score S or more is K n exp(-lambda S). lambda solves
E[exp(lambda s)] = 1 over the word scores of the texts labelled 0, with a bound for words
never seen there, and K is fitted to the same texts. The expectations are turned into bits,
-log2(E), summed over a text's significant passages, and mapped to a probability by a
one-variable logistic fit on the labelled texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import ready, scratch, whole_text
from gridmarts.llm.shingles import in_pieces, shingle_sets

PREFIXES = (4, 5, 6)
PIECE = 500_000  # characters that are hashed at once, which bounds a worker's arrays
# letters and combining marks: words are runs of letters, in lower case
WORD = re.compile(r"[^\W\d_]+")


LOWEST, HIGHEST = -2.5, 6.0


@dataclass
class Model:
    """``weights``, log-odds by feature, is bounded in ``learn``, so it is small enough to ship.

    ``base`` is the score of words without a known feature.
    """

    weights: dict[str, float]
    base: float
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 0.0
    offset: float = 0.0
    least_evalue: float = 0.05
    cache: dict = field(default_factory=dict, repr=False)

    def word_score(self, word: str) -> float:
        found = self.cache.get(word)
        if found is None:
            known = (self.weights[f] for f in features(word) if f in self.weights)
            found = max(LOWEST, min(HIGHEST, next(known, self.base)))
            if len(self.cache) < 100_000:
                self.cache[word] = found
        return found

    def segments(self, text: str) -> list[tuple[int, int, float, float]]:
        """(start, end, score, expected number by chance) of significant passages, code points."""
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        scores = [self.word_score(text[a:b].lower()) for a, b in spans]
        out = []
        for i, j, score in maximal_segments(scores):
            expected = self.scale * len(scores) * math.exp(-self.rate * score)
            if expected <= self.least_evalue:
                out.append((spans[i][0], spans[j - 1][1], score, expected))
        return out

    def bits(self, text: str) -> float:
        return sum(min(60.0, -math.log2(max(e, 1e-300))) for _, _, _, e in self.segments(text))

    def probability(self, bits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(bits) + self.offset, -30, 30)))


def features(word: str) -> list[str]:
    """The word, then its beginnings marked by a star, the longest first."""
    return [word, *(word[:k] + "*" for k in reversed(PREFIXES) if len(word) >= k)]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [i, j) in one pass.

    Positive stretches are pushed on a stack with the running totals before and after them;
    a new one swallows those it extends. Each is pushed and removed at most once, and the
    links to the nearest entry with a lower starting total keep the search linear.
    """
    start, end, low, high, lower = [], [], [], [], []
    total = 0.0
    for k, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        i, j, l, h = k, k + 1, before, total
        at = len(start) - 1
        while True:
            while at >= 0 and low[at] >= l:
                at = lower[at]
            if at < 0 or high[at] >= h:
                break
            i, l = start[at], low[at]
            del start[at:], end[at:], low[at:], high[at:], lower[at:]
            at -= 1
        start.append(i), end.append(j), low.append(l), high.append(h), lower.append(at)
    return [(i, j, h - l) for i, j, l, h in zip(start, end, low, high)]


def _text_features(batches):
    for frame in batches:
        for label, text in zip(frame["label"], frame["text"]):
            seen = {f for w in {w.lower() for w in WORD.findall(text)} for f in features(w)}
            if seen:  # a frame without rows would have no strings, which Arrow refuses
                yield pd.DataFrame({"feature": sorted(seen), "label": np.int64(label)})


def _near_copy_key(batches):
    """The smallest shingle hash: near copies have it in common more often than not."""
    for frame in batches:
        texts = frame["text"].to_list()
        for lo, hi in in_pieces(texts, PIECE):
            keys = [int(s[0].astype(np.int64)) if len(s) else 0 for s in shingle_sets(texts[lo:hi])]
            yield frame.iloc[lo:hi].assign(key=keys)


def _chances(counted: DataFrame, base: float, prior: float) -> DataFrame:
    """(feature, y, chance, parent): the chance of label 1 with the feature, from short to long ones."""

    def level(rows: DataFrame, parent) -> DataFrame:
        chance = (F.col("y1") + prior * parent) / (F.col("y") + prior)
        return rows.select("feature", "y", chance.alias("chance"), parent.alias("parent"))

    known = None
    for k in (*PREFIXES, 0):  # 0: whole words
        of_kind = F.col("feature").endswith("*") & (F.length("feature") == k + 1) if k else ~F.col("feature").endswith("*")
        rows = counted.where(of_kind)
        if known is None:
            made = level(rows, F.lit(base))
        else:
            up = F.substring("feature", 1, k - 1) if k else F.substring("feature", 1, max(PREFIXES))
            shorter = known.select(F.col("feature").alias("up"), F.col("chance").alias("held"))
            rows = rows.withColumn("up", F.concat(up, F.lit("*"))).join(shorter, "up", "left")
            made = level(rows, F.coalesce("held", F.lit(base)))
        # a word of 4 or 5 letters has its parent among the shorter beginnings
        known = made if known is None else known.union(made)
    return known


def learn(
    labelled: DataFrame,
    text_column: str = "text",
    label_column: str = "label",
    most_features: int = 50_000,
    prior: float = 5.0,
    least_texts: int = 3,
    least_change: float = 0.5,
) -> Model:
    """A model from rows of text and label (1 or 0; other labels and null are left out).

    The table should be bounded, see ``bounded_labels``: a score and a label of each row come
    to the driver. The ``most_features`` features that tell most beyond their shorter beginnings are kept.
    Without rows of both labels, a model with no weights results, which scores every text alike.
    """
    spark = labelled.sparkSession
    ready(spark)
    rows = labelled.select(
        whole_text(text_column).alias("text"), F.col(label_column).cast("int").alias("label")
    ).where("label in (0, 1)")
    with scratch(spark, "toxic-learn") as tables:
        # exact copies are reduced where they are read; the shuffle gathers the few rows of each input file
        keyed = rows.distinct().mapInPandas(_near_copy_key, "text string, label int, key long")
        chosen = tables.store(keyed.dropDuplicates(["key", "label"]).select("text", "label"), "chosen")
        totals = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
        n1, n0 = totals.get(1, 0), totals.get(0, 0)
        if not n1 or not n0:
            return Model({}, -1.0)
        base = n1 / (n1 + n0)
        counted = (
            chosen.mapInPandas(_text_features, "feature string, label long")
            .groupBy("feature")
            .agg(F.sum("label").alias("y1"), F.count("*").alias("y"))
            .where(F.col("y") >= least_texts)
        )
        chances = _chances(tables.store(counted, "counted"), base, prior)
        odds, before = (F.log(F.col(c) / (1 - F.col(c))) for c in ("chance", "parent"))
        told = chances.select("feature", odds.alias("w"), F.abs(odds - before).alias("change"), "y")
        kept = told.where(F.col("change") >= least_change)
        kept = kept.orderBy(F.desc(F.col("change") * F.sqrt("y")), "feature").limit(most_features)
        model = Model({r["feature"]: r["w"] for r in kept.collect()}, math.log(base / (1 - base)))
        _calibrate(model, chosen)
        return model


def _histograms(model: Model):
    def run(batches):
        for frame in batches:
            grid: dict[float, int] = {}
            for text in frame["text"]:
                for w in WORD.findall(text):
                    s = round(model.word_score(w.lower()), 2)
                    grid[s] = grid.get(s, 0) + 1
            yield pd.DataFrame({"score": list(grid.keys()), "words": list(grid.values())}).astype(
                {"score": "float64", "words": "int64"}
            )

    return run


def _best_scores(model: Model):
    def run(batches):
        for frame in batches:
            scores = [[model.word_score(w.lower()) for w in WORD.findall(t)] for t in frame["text"]]
            best = [max((s for _, _, s in maximal_segments(x)), default=0.0) for x in scores]
            yield pd.DataFrame({"label": frame["label"], "words": [len(x) for x in scores], "best": best})

    return run


def _bits(model: Model):
    def run(batches):
        for frame in batches:
            yield pd.DataFrame({"label": frame["label"], "bits": [model.bits(t) for t in frame["text"]]})

    return run


def _calibrate(model: Model, chosen: DataFrame) -> None:
    """Fit lambda, K and the logistic map. All that comes to the driver are bounded tables."""
    plain = chosen.where("label = 0").select("text").mapInPandas(_histograms(model), "score double, words long")
    grid = plain.groupBy("score").agg(F.sum("words").alias("words")).toPandas()  # scores on a grid of 0.01
    scores, freq = grid["score"].to_numpy(), grid["words"].to_numpy(dtype=float)
    # add what a positive score never seen in ordinary text might still weigh
    scores, freq = np.r_[scores, HIGHEST], np.r_[freq, 0.5]
    freq /= freq.sum()
    lo, hi = 1e-3, 20.0
    if (scores * freq).sum() < 0:
        for _ in range(100):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (np.exp(mid * scores) * freq).sum() < 1 else (lo, mid)
        model.rate = lo

    # P(best < s) = exp(-K n exp(-lambda s)), so the likelihood gives 1/K = mean of n exp(-lambda best)
    rows = chosen.select("label", "text").mapInPandas(_best_scores(model), "label int, words long, best double")
    rows = rows.toPandas()
    ordinary = rows[(rows["label"] == 0) & (rows["words"] > 0)]
    mean = float((ordinary["words"] * np.exp(-model.rate * ordinary["best"])).mean()) if len(ordinary) else 1.0
    model.scale = 1 / max(mean, 1e-9)
    bits = chosen.select("label", "text").mapInPandas(_bits(model), "label int, bits double").toPandas()
    y, x = bits["label"].to_numpy(dtype=float), np.log1p(bits["bits"].to_numpy())
    slope, offset = 0.0, 0.0
    for _ in range(200):  # Newton steps of a logistic fit, slightly held towards zero
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - y) * x).sum() + 0.01 * slope, (p - y).sum() + 0.01 * offset])
        hess = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        slope, offset = slope - step[0], offset - step[1]
    model.slope, model.offset = max(slope, 0.0), offset


def scored(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows with ``toxic_score`` in 0 to 1 and ``passages``, the significant passages found.

    Null and empty texts have no passages and get the score of a text without any. All rows
    and their columns stay; columns of these two names are replaced.
    """
    ready(documents.sparkSession)
    shipped = Model(model.weights, model.base, model.rate, model.scale, model.slope, model.offset, model.least_evalue)

    @F.pandas_udf("score double, passages array<struct<start:int,end:int,score:double,expected:double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shipped.segments(t) for t in texts]
        bits = np.array([sum(min(60.0, -math.log2(max(e, 1e-300))) for *_, e in f) for f in found], dtype=float)
        rows = [[{"start": a, "end": b, "score": s, "expected": e} for a, b, s, e in f] for f in found]
        return pd.DataFrame({"score": shipped.probability(bits), "passages": rows})

    out = documents.withColumn("_toxic", run(whole_text(text_column)))
    return out.withColumns({"toxic_score": F.col("_toxic.score"), "passages": F.col("_toxic.passages")}).drop("_toxic")


def held_out(id_column: str = "doc_id"):
    """True for the quarter of the ids from which nothing is learned."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2


def bounded_labels(labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """(doc_id, label) of at most ``most_rows`` labelled documents outside the held-out quarter.

    Those with the smallest hashes of their ids are taken. A null id or label teaches nothing;
    an id that is labelled twice counts as toxic if either row says so.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)


def learn_from_tables(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents; the labels are bounded, so they are broadcast."""
    return learn(documents.select("doc_id", "text").join(F.broadcast(bounded_labels(labels)), "doc_id"))
