"""Document rates that bring a corpus to target shares of its domains.

1. A naive Bayes classifier is counted from a labelled table: words by domain, each word
   once per document. The ``most_words`` words that tell most are its lexicon.
2. Every document gets soft memberships p, the posterior over the domains. Words of a
   text depend on each other, so the evidence counts as that of at most ``evidence`` words;
   a text that is half in one domain and half in another stays between them.
3. Rates r >= ``lowest``, with no upper bound unless ``highest`` is given, are fitted so that the expected tokens of
   each domain, sum of r n p, meet its target: projected gradient descent on the squares of
   the misses, relative to the domains' sizes. A step needs one number per domain, so it is
   one aggregation over the documents. In the metric of n and with that scaling the curvature is
   at most 1, and step size 1 is safe. Targets that cannot be met are an error.
4. ``copies`` rounds a rate to whole copies: up or down by a hash of the document, so that
   the expectation is the rate and a task that runs again decides alike.

Everything is built-in SQL.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import Scratch, fresh, scratch, whole_text

WORD_GAP = r"[^\p{L}]+"
PATIENCE = 20  # steps without gain after which targets count as out of reach


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "")


def learn(labelled: DataFrame, domains: list[str], most_words: int = 8_000, least: int = 3) -> DataFrame:
    """(word, odds) from rows of text and domain: log P(word | domain) by domain.

    At most ``most_words`` rows, so the table may be broadcast. Rows of other domains or of none teach nothing.
    """
    rows = labelled.where(F.col("domain").isin(domains)).select(whole_text().alias("text"), "domain")
    seen = rows.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    by_domain = [F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)]
    counts = seen.groupBy("word").agg(*by_domain)
    totals = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}  # a row per domain
    rate = [(F.col(f"n{k}") + 0.5) / F.lit(totals.get(d, 0) + 1.0) for k, d in enumerate(domains)]
    odds = F.array(*(F.log(r) for r in rate))
    often = sum(F.col(f"n{k}") for k in range(len(domains)))
    # the frequency times the spread of the rates: what the word tells over the corpus
    spread = F.log(F.greatest(*rate)) - F.log(F.least(*rate)) if len(domains) > 1 else F.lit(0.0)
    best = counts.where(often >= least).select("word", odds.alias("odds"), (often * spread).alias("tells"))
    return best.orderBy(F.desc("tells"), "word").limit(most_words).select("word", "odds")


def memberships(documents: DataFrame, lexicon: DataFrame, domains: list[str], evidence: float = 20.0) -> DataFrame:
    """(node, n, p): a row per distinct document, its words and its posterior over the domains.

    ``node`` is the hash of ``key``, the columns of ``documents`` that tell rows apart, and text. Texts
    without known words are as likely of each domain.
    """
    k = len(domains)
    split = documents.select("node", F.explode_outer(F.split(F.lower("text"), WORD_GAP)).alias("word"))
    held = F.broadcast(lexicon.select("word", *(F.element_at("odds", i + 1).alias(f"o{i}") for i in range(k))))
    summed = split.join(held, "word", "left").groupBy("node").agg(
        F.count_if(F.col("word") != "").alias("n"),
        F.count("o0").alias("known"),
        *(F.sum(f"o{i}").alias(f"s{i}") for i in range(k)),
    )
    scale = F.lit(evidence) / F.greatest(F.lit(evidence), F.col("known").cast("double"))
    logits = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * scale for i in range(k)]
    top = F.greatest(*logits) if k > 1 else logits[0]
    weights = [F.exp(x - top) for x in logits]
    total = reduce(lambda a, b: a + b, weights)
    return summed.select("node", "n", F.array(*(w / total for w in weights)).alias("p"))


def fit_rates(
    members: DataFrame,
    targets: list[float],
    tables: Scratch,
    budget: float | None = None,
    lowest: float = 0.0,
    highest: float | None = None,
    close: float = 1e-3,
    steps: int | None = None,
) -> DataFrame:
    """The rows (weight, n, p) with ``rate``. ``weight`` counts equal documents.

    ``budget`` is the expected number of tokens; by default the present one, or, where rates
    below ``lowest`` would be needed to keep to it, as many more as no rate has to fall below it.
    Steps go on until no domain misses its target by more than ``close`` of the budget. Where
    that cannot be reached, as no document has enough of a domain, a ValueError gives the misses.
    ``highest`` and ``steps`` are limits of the caller's own: a miss they leave is a warning.
    """
    k = len(targets)
    shares = [t / sum(targets) for t in targets]
    tokens = F.col("n") * F.col("weight")

    def totals(df: DataFrame, rate: Column) -> list[float]:
        row = df.agg(*(F.sum(rate * tokens * F.element_at("p", i + 1)).alias(f"d{i}") for i in range(k))).first()
        return [row[i] or 0.0 for i in range(k)]

    stored = "rates"
    held = tables.store(members.withColumn("rate", F.greatest(F.lit(lowest), F.lit(1.0))), stored)
    now = totals(held, F.lit(1.0))
    if not sum(now):
        return held
    free = budget is None and lowest > 0
    if budget is None:
        budget = max(sum(now), *(lowest * d / t for d, t in zip(now, shares) if t))
    sizes = [max(d, 1e-9 * sum(now)) for d in now]
    moves: list[list[float]] = []

    def moved(moves: list[list[float]]) -> Column:
        """The rate after these steps from the stored one."""
        rate = F.col("rate")
        for move in moves:
            slope = sum((F.element_at("p", i + 1) * F.lit(g) for i, g in enumerate(move)), F.lit(0.0))
            rate = rate - slope if highest is None else F.least(F.lit(highest), rate - slope)
            rate = F.greatest(F.lit(lowest), rate)
        return rate

    before = best = math.inf
    gained = 0  # the last step that brought the worst miss down
    for step in count():
        now = totals(held, moved(moves))
        missed = [d / budget - t for d, t in zip(now, shares)]
        worst = max(abs(m) for m in missed)
        if worst < 0.99 * best:
            best, gained = worst, step
        if worst <= close or step == steps or (steps is None and step - gained >= PATIENCE):
            break
        if free and worst > 0.9 * before:
            # repeated documents also bring tokens of a domain that may not have more, and none may go
            budget = max(budget, *(d / t for d, t in zip(now, shares) if t))
        before = worst
        moves.append([(d - budget * t) / s for d, t, s in zip(now, shares, sizes)])
        if len(moves) == 4:  # keep the expression short
            held = tables.store(held.withColumn("rate", moved(moves)), f"rates{step}")
            tables.drop(stored)
            stored, moves = f"rates{step}", []
    if worst > close:
        text = f"targets are missed after {step} steps, by domain and as shares of all tokens: {missed}"
        if highest is None and steps is None:
            raise ValueError(text)
        warnings.warn(text, stacklevel=2)
    return held.withColumn("rate", moved(moves))


def mixed(
    documents: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
    **limits,
) -> DataFrame:
    """All rows and columns of ``documents`` with n_tokens, posteriors, rate and copies.

    ``labelled`` has text and domain. ``targets`` maps domains to shares. Documents with equal
    id and text share a rate. Null and empty texts have no tokens, no part in the fit, and the rate
    that a text of no known domain gets. ``limits`` are those of ``fit_rates``, which also says what
    happens when targets cannot be met. A domain without a labelled row cannot be told from others: its
    posterior is 0, its share falls to the others in proportion, and a warning names it. Columns of the added
    names are replaced. Empty tables give an empty result.
    """
    spark = documents.sparkSession
    all_domains = sorted(targets)
    present = {r[0] for r in labelled.where(F.col("domain").isin(all_domains)).select("domain").distinct().collect()}
    domains = [d for d in all_domains if d in present] or all_domains
    if len(domains) < len(all_domains):
        warnings.warn(f"no labelled row of {sorted({*all_domains} - present)}: their shares go to the others", stacklevel=2)
    node = fresh(documents, "node")
    with scratch(spark, "mixing") as tables:
        rows = documents.withColumn(node, F.xxhash64(F.col(id_column), whole_text(text_column)))
        lexicon = tables.store(learn(labelled, domains), "lexicon")
        plain = rows.select(F.col(node).alias("node"), whole_text(text_column).alias("text"))
        counted = tables.store(memberships(plain, lexicon, domains), "members")
        # repeated rows were counted together: their words count once per row
        copies = rows.groupBy(F.col(node).alias("node")).agg(F.count("*").alias("weight"))
        members = counted.join(copies.hint("merge"), "node").withColumn("n", (F.col("n") / F.col("weight")).cast("long"))
        rates = fit_rates(members, [targets[d] for d in domains], tables, **limits)
        shares = [F.element_at("p", domains.index(d) + 1) if d in domains else F.lit(0.0) for d in all_domains]
        out = tables.store(
            rates.select(
                F.col("node").alias(node), F.col("n").alias("n_tokens"), F.array(*shares).alias("posteriors"), "rate"
            ),
            "result",
        )
    chance = F.pmod(F.xxhash64(F.lit("copies"), node), F.lit(1 << 30)) / float(1 << 30)
    whole = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    clash = [c for c in ("n_tokens", "posteriors", "rate", "copies") if c in documents.columns]
    return rows.drop(*clash).join(out.hint("merge"), node).withColumn("copies", whole).drop(node)


def bounded_labels(documents: DataFrame, domain_column: str = "lang", most_rows: int = 20_000) -> DataFrame:
    """(text, domain) of at most ``most_rows`` documents, those with the smallest hashes of their ids.

    The chosen ids are bounded and are broadcast; the texts stay where they are.
    """
    known = documents.where(F.col(domain_column).isNotNull()).select("doc_id").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    return documents.join(F.broadcast(chosen), "doc_id").select("text", F.col(domain_column).alias("domain"))
