"""Personal data: four base patterns, and a conditional random field for what they miss.

The base patterns are exact and always count. A linear-chain conditional random field over the
shapes of white-space tokens, trained from a small labelled table, adds spans: telephone
numbers without a plus sign, written-out addresses such as ``name (at) host.org`` or ``name at host dot org``,
and the like. Its labels are O and one per kind. Every token is decoded: texts are cut into windows of
``WINDOW`` tokens, each with ``CONTEXT`` more on both sides, so that Viterbi and the forward-backward sums run over
numpy batches of windows; the labels of a window's own tokens count.

An added span needs a mean posterior of ``least`` and must not touch a base span; kinds of
added spans are written ``crf_phone`` and so on.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import ready, whole_text

# The base kinds in their order, and their patterns. Where a pattern has ++ or a
# look-behind, it finds what the plain form finds, without going over a long run of digits again and again.
KINDS = ("email", "ip", "card", "phone")
LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
TOKEN = re.compile(r"\S+")
AT = re.compile(r"@|[(\[]at[)\]]")

WINDOW, CONTEXT = 64, 12
SLICE = 200_000  # characters of texts that are worked on at once; a longer text alone
MOST_TOKENS = 200_000  # distinct tokens whose scores are kept
LABELS = ("O", *KINDS)
EDGES = ".,;:!?\"'"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base spans, sorted."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = NO_DIGIT.sub("", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# The labelled table is written as templates: # is a digit, ~ an invented word, and marked stretches have their kind.
TEMPLATES = (
    ("call {phone:(###) ###-####} today", 8),
    ("phone {phone:###-###-####} or write", 8),
    ("tel. {phone:###.###.####}, ask for them", 8),
    ("fax {phone:### ### ####} anytime", 8),
    ("reach us at {phone:0## ### ## ##} please", 6),
    ("Telefon {phone:0###/#######} im Hause", 6),
    ("number {phone:+# (###) ###-####} works", 8),
    ("mobile {phone:+## ### ### ###} only", 6),
    ("{phone:1-###-###-####} is the line", 6),
    ("mail {email:ann.lee##@mail#.example.com} soon", 8),
    ("write to {email:jo@host.org} now", 6),
    ("send {email:max (at) firma.de} a note", 8),
    ("ask {email:eva [at] web.net} for it", 8),
    ("to {email:tom_k@site.example.org}, thanks", 6),
    ("from {ip:##.###.##.##} came the request", 6),
    ("host {ip:###.#.#.###} is down", 6),
    ("card {card:####-####-####-####} expired", 6),
    ("pay with {card:#### #### #### ####} online", 6),
    ("the card {card:################} was used", 6),
    ("in ##, there were #### of them", 8),
    ("version #.# and later", 6),
    ("version #.#.# of the tool", 6),
    ("Licensed under the terms, Version #.#. See there", 6),
    ("on ##.##.#### at ##:## sharp", 8),
    ("since ####-##-## it has grown", 8),
    ("about ##,### people, or ##% of all", 8),
    ("it costs $##.## or EUR ##", 8),
    ("section ##.# on page ###", 8),
    ("password=##a##b##c##d## stays out of it", 4),
    ("key = ##ab##cd##ef## in the file", 4),
    ("order ######## was sent", 8),
    ("serial ####-##-#### of the part", 6),
    ("pages ###-### and ####-####", 8),
    ("the ratio #/# and the sum # + #", 6),
    ("follow @someone on it", 8),
    ("see you @ noon", 6),
    ("the sh and of ## the ing", 8),
    ("#,###,### rows in ### tables", 6),
    ("~ ~ {phone:0# ## ## ## ##} ~ ~", 10),
    ("tel: {phone:0# ## ## ## ##}", 6),
    ("~ {phone:0##-####-####} ~", 6),
    ("~ ~ {phone:0### ######} ~", 6),
    ("~ {phone:(0##) #### ####}, ~", 6),
    ("~ {phone:###-###-####} ~ ~", 10),
    ("~ ~ {phone:(###) ###-####} ~", 10),
    ("~ {phone:(###)###-####} ~", 8),
    ("~ {phone:###.###.####} ~", 8),
    ("{phone:00## ### #######} ~ ~", 6),
    ("~ {phone:### ### ####} ~ ~", 6),
    ("~ ~ {email:~ at ~ dot com} ~ ~", 10),
    ("{email:~ at ~ dot org} ~", 8),
    ("~ {email:~ at ~ dot net}", 8),
    ("mail {email:~ dot ~ at ~ dot com} ~", 8),
    ("~ {email:~ (at) ~ (dot) com} ~", 8),
    ("~ {email:~ [at] ~ [dot] org} ~", 8),
    ("~ {email:~(at)~.org} ~", 10),
    ("~ ~ {email:~.~(at)~.com} ~", 8),
    ("~ {email:~[at]~.de} ~", 8),
    ("~ {email:~(at)~(dot)com} ~", 8),
    ("~ {email:~##(at)~.net}, ~", 6),
    ("~ {email:~ (at) ~.com} ~", 8),
    ("~ {email:~ [at] ~.org}, ~", 8),
    ("~ {email:~ @ ~.com} ~", 8),
    ("~ {email:~.~(at)~-~.de} ~", 8),
    ("~ {email:~(at)~-~.com}, ~", 8),
    ("~ ({email:~(at)~.com}) ~", 8),
    ("({email:~.~[at]~.org}), ~", 8),
    ("~ ({phone:###-###-####}) ~", 6),
    ("~ {ip:##.##.#.###}:#### ~", 4),
    ("~ ~ at ~ ~ ~", 12),
    ("~ at ~ in ~ ~, ~", 8),
    ("look at ~.com is what ~ ~", 6),
    ("meet at ~ and ~ the dot of ~", 8),
    ("a dot ~ at ~ ~", 6),
    ("the red dot com ~ of ~", 6),
    ("~ ~ ~ ~ ~ ~ ~ ~", 20),
    ("~, ~ ~. ~ ~ ~", 12),
    ("~.~ and ~.~.~ ~", 6),
    ("~ ~.com ~ ~.org", 6),
    ("~ (~) ~ [~] ~", 8),
    ("~ #### ~ ## ~ ###", 8),
    ("~ ## ## ~", 6),
    ("## ## ## are numbers of ~", 6),
    ("lottery # ## ## ## ## ~", 4),
    ("id ###-##-#### ~ ~", 4),
    ("invoice ####### of ~ ~", 6),
    ("~_~ = #### ~", 4),
    ("isbn ###-#-###-#####-# ~", 6),
)
SYLLABLES = "ba co da el fi go ha in jo ka lu me no or pe qui ra se ti ul ve wa xi yo zu an ber ster mon".split()


def labelled_rows(seed: int = 11) -> pd.DataFrame:
    """The labelled table: text, and spans as (start, end, kind). A few hundred rows."""
    rng, rows = random.Random(seed), []
    for template, times in TEMPLATES:
        for _ in range(times):
            text, spans = "", []
            for part in re.split(r"(\{\w+:[^}]*\})", template):
                kind, _, body = part[1:-1].partition(":") if part.startswith("{") else ("", "", part)
                body = re.sub("#", lambda m: rng.choice("123456789"), body)
                body = re.sub("~", lambda m: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))), body)
                if kind:
                    spans.append((len(text), len(text) + len(body), kind))
                text += body
            rows.append((text, spans))
    return pd.DataFrame(rows, columns=["text", "spans"])


def core(text: str, span: tuple[int, int]) -> tuple[int, int]:
    """The token without punctuation at its edges."""
    a, b = span
    while a < b and text[a] in EDGES:
        a += 1
    while b > a and text[b - 1] in EDGES:
        b -= 1
    return (a, b) if a < b else span


def shape(token: str) -> str:
    """Letters by case, runs collapsed; runs of digits keep their length up to 4. ``at`` and ``dot`` are kept in brackets."""
    kept = re.sub(r"([(\[])(at|dot)([)\]])", lambda m: m[1] + ("\0" if m[2] == "at" else "\1") + m[3], token)
    kept = re.sub(r"[^\W\d_]+", lambda m: "A" if m.group().isupper() else "a", kept)
    kept = re.sub(r"[0-9]+", lambda m: "9" * len(m.group()) if len(m.group()) <= 4 else "9+", kept)
    return kept.replace("\0", "at").replace("\1", "dot")


def own_features(token: str) -> tuple[str, str, str]:
    """Of a token without the punctuation at its edges: its shape, its digits and any at, and the token where it is a word."""
    whole = token[slice(*core(token, (0, len(token))))]
    digits = len(NO_DIGIT.sub("", whole))
    at = "@" if AT.search(whole) else ""
    return f"s{shape(whole)}", f"d{min(digits, 12)}{at}", f"w{whole.lower()}" if whole.isalpha() else "w"


BEFORE, AFTER = ("s^", "d^", "w^"), ("s$", "d$", "w$")
FEATURES = 12


def stretch_features(tokens: list[str]) -> list[list[str]]:
    """The features of each token of a whole text: its own, its neighbours', and pairs of shapes."""
    own = [BEFORE, *map(own_features, tokens), AFTER]
    return [
        ["*", *(f"0{f}" for f in x), *(f"-{f}" for f in w), *(f"+{f}" for f in y), f"{w[0]}|0|{x[0]}", f"{x[0]}|1|{y[0]}"]
        for w, x, y in zip(own, own[1:], own[2:])
    ]


@dataclass
class Crf:
    """``index`` maps features to rows of ``weights``; row 0 is for unknown ones and stays 0."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, rows: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (text, token, label), padded, and the lengths."""
        sizes = np.array([len(r) for r in rows])
        ids = np.zeros((len(rows), sizes.max(), FEATURES), dtype=np.int64)
        for i, row in enumerate(rows):
            ids[i, : len(row)] = [[self.index.get(f, 0) for f in token] for token in row]
        return self.weights[ids].sum(axis=2), sizes

    def decode(self, rows: list[list[list[str]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The best labels of each row of tokens and their posteriors."""
        scores, sizes = self.emissions(rows)
        labels = viterbi(scores, sizes, self.moves)
        sure = _chance(scores, sizes, self.moves, labels)
        return [x[:s] for x, s in zip(labels, sizes)], [x[:s] for x, s in zip(sure, sizes)]


def viterbi(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best labels (row, token); 0 beyond the length of a row."""
    n, steps, k = scores.shape
    best, back = scores[:, 0].copy(), np.zeros((n, steps, k), dtype=np.int8)
    for t in range(1, steps):
        options = best[:, :, None] + moves
        back[:, t] = options.argmax(axis=1)
        on = t < sizes
        best[on] = (options.max(axis=1) + scores[:, t])[on]
    labels = np.zeros((n, steps), dtype=np.int8)
    labels[np.arange(n), sizes - 1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        on = np.flatnonzero(t < sizes)
        labels[on, t - 1] = back[on, t, labels[on, t]]
    return labels


def _chance(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray, labels: np.ndarray) -> np.ndarray:
    single = posteriors(scores, sizes, moves)[0]
    return np.take_along_axis(single, labels[:, :, None].astype(np.int64), axis=2)[:, :, 0]


class Rows(dict):
    """Where a token's scores are. Words that the model does not know share a place."""

    def __init__(self, scorer: Scorer):
        super().__init__()
        self.scorer = scorer

    def __missing__(self, token: str) -> int:
        whole = token.strip(EDGES) or token
        if whole.isalpha() and whole.lower() not in self.scorer.words:
            features = ("sA" if whole.isupper() else "sa", "d0", "w?")
        else:
            features = own_features(token)
        self[token] = row = self.scorer.row(features)
        return row


class Scorer:
    """Scores of tokens out of tables, so a repeated token costs a look-up."""

    def __init__(self, model: Crf):
        self.model, k = model, len(LABELS)
        pairs = [f.split("|") for f in model.index if "|0|" in f or "|1|" in f]
        pairs = [(f[0], f[-2], f[-1]) for f in pairs if len(f) == 3]
        self.shapes = {s: i for i, s in enumerate(sorted({x for a, _, b in pairs for x in (a, b)}), 1)}
        self.pairs = np.zeros((2, len(self.shapes) + 1, len(self.shapes) + 1, k))
        for a, side, b in pairs:
            self.pairs[int(side), self.shapes[a], self.shapes[b]] = model.weights[model.index[f"{a}|{side}|{b}"]]
        self.words = {f[2:] for f in model.index if f.startswith("0w")}
        self.clear()

    def clear(self) -> None:
        self.rows = Rows(self)
        self.known: dict[tuple[str, str, str], int] = {}
        self.table: list[np.ndarray] = []
        self.kinds: list[int] = []
        for features in (BEFORE, AFTER):
            self.row(features)

    def row(self, features: tuple[str, str, str]) -> int:
        """The place of these features in the table of scores."""
        if features not in self.known:
            w, index = self.model.weights, self.model.index
            self.table.append(np.array([w[[index.get(p + f, 0) for f in features]].sum(axis=0) for p in "0-+"]))
            self.kinds.append(self.shapes.get(features[0], 0))
            self.known[features] = len(self.table) - 1
        return self.known[features]

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        """(token, label) over all texts one after another."""
        if len(self.rows) > MOST_TOKENS:
            self.clear()
        ids = []
        for tokens in texts:
            ids.append(0)
            ids.extend(map(self.rows.__getitem__, tokens))
            ids.append(1)
        at = np.array(ids, dtype=np.int64)
        inner = np.flatnonzero(at > 1)
        table, kind = np.stack(self.table), np.array(self.kinds)[at]
        return (
            self.model.weights[self.model.index["*"]] + table[at[inner], 0] + table[at[inner - 1], 1] + table[at[inner + 1], 2]
            + self.pairs[0, kind[inner - 1], kind[inner]] + self.pairs[1, kind[inner], kind[inner + 1]]
        )

    def labels(self, texts: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The labels of the tokens of each text, and the posteriors of those that are not O."""
        texts_at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not texts_at[-1]:
            return [np.zeros(0, np.int8) for _ in texts], [np.zeros(0) for _ in texts]
        scores, windows = self.scores(texts), []
        for lo, hi in zip(texts_at, texts_at[1:]):
            starts = np.arange(lo, hi, WINDOW)
            ends = np.minimum(starts + WINDOW, hi)
            windows.append(np.stack([np.maximum(starts - CONTEXT, lo), starts, ends, np.minimum(ends + CONTEXT, hi)], 1))
        windows = np.concatenate(windows)
        labels, sure = np.zeros(len(scores), np.int8), np.ones(len(scores))
        for first in range(0, len(windows), 4096):
            lo, start, end, hi = windows[first : first + 4096].T
            sizes = hi - lo
            steps = np.arange(sizes.max())
            places = np.minimum(lo[:, None] + steps, hi[:, None] - 1)
            best = viterbi(scores[places], sizes, self.model.moves)
            own = (places >= start[:, None]) & (places < end[:, None]) & (steps < sizes[:, None])
            labels[places[own]] = best[own]
            some = np.flatnonzero((best * own).any(axis=1))
            if len(some):
                chance = _chance(scores[places[some]], sizes[some], self.model.moves, best[some])
                sure[places[some][own[some]]] = chance[own[some]]
        return np.split(labels, texts_at[1:-1]), np.split(sure, texts_at[1:-1])


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


def posteriors(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray):
    """Of labels by token, and summed over tokens of pairs of labels; and the log of the sums."""
    n, steps, k = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, steps):
        ahead[:, t] = _lse(ahead[:, t - 1][:, :, None] + moves, 1) + scores[:, t]
    for t in range(steps - 2, -1, -1):
        on = t + 1 < sizes
        behind[on, t] = _lse(moves + (scores[on, t + 1] + behind[on, t + 1])[:, None, :], 2)
    total = _lse(ahead[np.arange(n), sizes - 1], 1)
    mask = np.arange(steps) < sizes[:, None]
    single = np.exp(np.minimum(0, ahead + behind - total[:, None, None])) * mask[:, :, None]
    pairs = np.zeros((k, k))
    for t in range(1, steps):
        on = t < sizes
        both = ahead[on, t - 1][:, :, None] + moves + (scores[on, t] + behind[on, t])[:, None, :]
        pairs += np.exp(np.minimum(0, both - total[on][:, None, None])).sum(axis=0)
    return single, pairs, total


def train(table: pd.DataFrame, steps: int = 250, rate: float = 0.1, hold: float = 0.005) -> Crf:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps.

    The table is small (``labelled_rows`` has a few hundred rows), so it is trained in one place.
    """
    rows, gold = [], []
    for text, spans in zip(table["text"], table["spans"]):
        rows.append(stretch_features(text.split()))
        own = []
        for a, b in (core(text, m.span()) for m in TOKEN.finditer(text)):
            inside = [k for lo, hi, k in spans if a < hi and b > lo]
            own.append(LABELS.index(inside[0]) if inside else 0)
        gold.append(own)
    names = sorted({f for r in rows for token in r for f in token})
    index = {f: i for i, f in enumerate(names, 1)}
    k = len(LABELS)
    model = Crf(index, np.zeros((len(index) + 1, k)), np.zeros((k, k)))
    sizes = np.array([len(r) for r in rows])
    ids = np.zeros((len(rows), sizes.max(), FEATURES), dtype=np.int64)
    right = np.zeros((len(rows), sizes.max(), k))
    seen = np.zeros((k, k))
    for i, (row, own) in enumerate(zip(rows, gold)):
        ids[i, : len(row)] = [[index[f] for f in token] for token in row]
        right[i, np.arange(len(own)), own] = 1
        np.add.at(seen, (own[:-1], own[1:]), 1)
    sums = [np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)]
    for _ in range(steps):
        single, pairs, _ = posteriors(model.weights[ids].sum(axis=2), sizes, model.moves)
        gradient = -hold * model.weights
        np.add.at(gradient, ids, (right - single)[:, :, None, :])
        gradient[0] = 0
        for value, g, held in zip((model.weights, model.moves), (gradient, seen - pairs - hold * model.moves), sums):
            held += g * g
            value += rate * g / np.sqrt(held)
    return model


def _sound(kind: str, text: str) -> bool:
    """What an added span has to have at least."""
    digits = NO_DIGIT.sub("", text)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        return bool(m := IP.fullmatch(text)) and all(map(_small, m.groups()))
    return bool(ADDRESS.fullmatch(text))


# something, an at, and names joined by dots, either of them spelled out or not
ADDRESS = re.compile(
    r"[\w.+-]+(?:\s+(?:dot|\.)\s+[\w+-]+)*(?:\s*[(\[]\s*at\s*[)\]]\s*|\s+at\s+|\s*@\s*)"
    r"[\w-]+(?:(?:\s*[(\[]\s*dot\s*[)\]]\s*|\s+dot\s+|\.)[\w-]+)+",
    re.IGNORECASE,
)


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], scorer: Scorer, least: float):
    """Per text, the (start, rank, end) that the field adds to the base spans."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, spans, own, labels, sure in zip(texts, base, out, *scorer.labels([t.split() for t in texts])):
        if not labels.any():
            continue
        places = [m.span() for m in TOKEN.finditer(text)]
        edges = np.flatnonzero(np.diff(labels, prepend=0, append=0))
        for lo, hi in zip(edges, edges[1:]):
            if not labels[lo]:
                continue
            a, b = core(text, places[lo])[0], core(text, places[hi - 1])[1]
            kind = LABELS[labels[lo]]
            if kind == "email":  # an address in brackets
                while a < b and text[a] in "([<":
                    a += 1
                while a < b and text[b - 1] in ")]>" + EDGES:
                    b -= 1
            free = all(b <= x or a >= y for x, _, y in spans)
            if free and sure[lo:hi].mean() >= least and _sound(kind, text[a:b]):
                own.append((a, len(KINDS) + KINDS.index(kind), b))
    return out


NAMES = (*KINDS, *(f"crf_{k}" for k in KINDS))


def _slices(texts: list[str]):
    """Neighbouring texts of some ``SLICE`` characters together; a longer one alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _find(model: Crf, least: float):
    scorers: list[Scorer] = []  # one per worker, made there

    def run(texts: pd.Series) -> pd.Series:
        if not scorers:
            scorers.append(Scorer(model))
        found = []
        for part in _slices(texts.to_list()):
            base = [base_spans(t) for t in part]
            more = added_spans(part, base, scorers[0], least)
            found += [
                [{"start": a, "rank": r, "end": b, "kind": NAMES[r]} for a, r, b in sorted(x + y)]
                for x, y in zip(base, more)
            ]
        return pd.Series(found)

    return run


SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def find_personal_data(
    documents: DataFrame, text_column: str = "text", model: Crf | None = None, least: float = 0.6
) -> DataFrame:
    """All rows and columns with ``pii_spans``: start, rank, end, kind, in code points, sorted.

    Null and empty texts have none. A column named ``pii_spans`` is replaced. Repeated rows are treated
    alike. An empty table gives an empty result.
    """
    ready(documents.sparkSession)
    find = _find(model or train(labelled_rows()), least)
    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return documents.withColumn("pii_spans", F.pandas_udf(find, SPAN)(whole_text(text_column)))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
