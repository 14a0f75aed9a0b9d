"""Runs of words that repeat with a period, and texts with the repeats taken out.

A run is a stretch of words with smallest period q (words q apart are alike) and a length of at least
``least`` words and two periods, which no neighbouring word extends.

1. Recursive frequency splitting. Every word of a run occurs in it at least twice, so a word that occurs once in its
   segment is in no run of that segment: it splits it. What is left between such words are the new segments, those shorter
   than ``least`` go, and the rest is split again until nothing changes. Counting is one sort of (segment, word).
2. Lag scan of the segments that survive, the longest first, so that those long enough for a lag are a prefix of the array.
   At lag q a run has at least m = max(least - q, q) neighbouring words that equal the word q further on, hence a place
   divisible by any step up to m - k + 1 where k words in a row do. Only those places are compared, by hashes of
   k words, which makes the scan as long as the words times the logarithm of the largest lag. A hit is extended both ways by
   comparing the words themselves.
3. A run of period q has every multiple of q for a period, too. The places at which a run would be found again are noted
   beforehand, so what is found has its smallest period.

Texts are worked on whole, a few million characters at a time; a longer text is worked on alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import fresh, ready, whole_text
from gridmarts.llm.shingles import in_pieces, mix

RUNS = "array<struct<start:long,length:long,period:long>>"


class _Numbers(dict):
    """Word -> a number of its own."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def words_of(text: str) -> list[bytes]:
    """The words of a text, between blanks and the controls from tab to carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def split_by_frequency(word: np.ndarray, segment: np.ndarray, least: int) -> np.ndarray:
    """The places that survive, ascending. ``segment`` numbers stretches of neighbouring places, ascending."""
    place = np.arange(len(word))
    while len(place):
        # of equal (segment, word) those with a neighbour in sorted order occur twice or more
        order = np.lexsort((word[place], segment))
        w, s = word[place][order], segment[order]
        same = (w[1:] == w[:-1]) & (s[1:] == s[:-1])
        twice = np.empty(len(place), dtype=bool)
        twice[order] = np.r_[False, same] | np.r_[same, False]
        stay, seg = place[twice], segment[twice]
        if not len(stay):
            return stay
        new = np.r_[True, (stay[1:] != stay[:-1] + 1) | (seg[1:] != seg[:-1])]
        number = np.cumsum(new) - 1
        long = (np.bincount(number) >= least)[number]
        if twice.all() and long.all():
            return place
        place, segment = stay[long], number[long]
    return place


class _Grams:
    """Hashes of the k words from each place on, for k a power of two, and ``more`` entries after the last."""

    def __init__(self, word: np.ndarray, more: int):
        self.rows = {1: np.r_[mix(word.astype(np.uint64) + np.uint64(1)), np.zeros(more, dtype=np.uint64)]}

    def of(self, k: int) -> np.ndarray:
        if k not in self.rows:
            half = self.of(k // 2)
            out = np.zeros(len(half), dtype=np.uint64)
            n = max(0, len(half) - k // 2)
            out[:n] = mix(half[:n] * np.uint64(0x9E3779B97F4A7C15) + half[len(half) - n :])
            self.rows[k] = out
        return self.rows[k]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries are alike, looking ever further."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, step * 4
    return n


class _Multiples:
    """Where a run would be found again, at multiples of its period."""

    def __init__(self, rich: int = 8):
        self.rich, self.few = rich, {}
        self.many = np.empty((0, 3), dtype=np.int64)  # start, end and period of runs with many periods

    def note(self, start: int, length: int, period: int) -> None:
        if length >= self.rich * period:
            self.many = np.r_[self.many, [(start, start + length, period)]]
            return
        for lag in range(2 * period, length - period + 1, period):
            self.few.setdefault(lag, []).append((start, start + length))

    def unseen(self, hits: np.ndarray, lag: int) -> np.ndarray:
        """The hits at a lag that lie in no run of which the lag is a multiple."""
        spans = self.few.pop(lag, [])
        if len(self.many):
            start, end, period = self.many.T
            fits = (lag % period == 0) & (end - start >= lag + period)
            spans = [*spans, *zip(start[fits].tolist(), end[fits].tolist())]
        if not spans:
            return hits
        if len(spans) == 1:
            return hits[(hits < spans[0][0]) | (hits + lag >= spans[0][1])]
        spans = np.array(sorted(spans))
        reach = np.maximum.accumulate(spans[:, 1])
        at = np.searchsorted(spans[:, 0], hits, side="right") - 1
        return hits[(at < 0) | (reach[np.maximum(at, 0)] <= hits + lag)]


def lag_scan(word: np.ndarray, length: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in segments laid one after the other, the longest first.

    ``word`` has a place after each segment with a number that occurs nowhere else. Stretches across such a place
    are shorter than their lag, so they are no runs.
    """
    ends = np.cumsum(length + 1)  # of each segment with the place after it
    grams, multiples, runs = _Grams(word, int(length[0]) // 8 + 1), _Multiples(), []
    lag = 1
    while True:
        wide = int(np.searchsorted(-length, -max(least, 2 * lag), side="right"))  # segments long enough
        if not wide:
            return runs
        size = int(ends[wide - 1])
        m = max(least - lag, lag)
        k = 1 << min(6, (m // 2).bit_length() - 1)
        step = m - k + 1
        gram = grams.of(k)
        # long lags are compared many at a time, all with the steps of the shortest
        lags = 1 if lag < 4 * least else max(1, min(lag // 4, 1 + (1 << 18) // (size // step + 1)))
        ahead = np.lib.stride_tricks.sliding_window_view(gram[lag : size + lags - 1], lags)[::step]
        which, hits = np.nonzero((gram[: len(ahead) * step : step, None] == ahead).T)
        cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1], True]) if len(which) else []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = lag + int(which[lo])
            _extend(word, size, own, multiples.unseen(hits[lo:hi] * step, own), least, multiples, runs)
        lag += lags


def _extend(word: np.ndarray, size: int, lag: int, hits: np.ndarray, least: int, multiples: _Multiples, runs: list) -> None:
    """Add the runs with this lag as period around the hits."""
    done = 0
    for i in hits.tolist():
        if i < done or i + lag >= size:
            continue
        ahead = _reach(word[i : size - lag], word[i + lag : size])
        if not ahead:
            continue
        back = _reach(word[:i][::-1], word[lag : i + lag][::-1])
        done = i + ahead
        start, long = i - back, back + ahead + lag
        if long >= max(least, 2 * lag):
            runs.append((start, long, lag))
            multiples.note(start, long, lag)


def runs_of(words: list[list[bytes]], least: int = 12) -> list[np.ndarray]:
    """For each list of words its runs: rows of start, length, period, ascending by start, then period."""
    number = _Numbers()
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    word = np.fromiter((number[x] for w in words for x in w), dtype=np.int64, count=sizes.sum())
    text = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    place = split_by_frequency(word, text, least)
    out = [np.empty((0, 3), dtype=np.int64)] * len(words)
    if not len(place):
        return out
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1] + 1) | (text[place[1:]] != text[place[:-1]])])
    length = np.diff(np.r_[new, len(place)])
    order = np.argsort(-length, kind="stable")
    begin, length = place[new[order]], length[order]
    laid = np.cumsum(length + 1) - (length + 1)  # where each segment begins in the array
    line = np.empty(int((length + 1).sum()), dtype=np.int64)
    inside = np.arange(len(line)) - np.repeat(laid, length + 1)
    last = inside == np.repeat(length, length + 1)
    line[~last] = word[np.repeat(begin, length + 1)[~last] + inside[~last]]
    line[last] = len(number) + np.arange(len(length))
    found = lag_scan(line, length, least)
    if not found:
        return out
    found = np.array(found, dtype=np.int64)
    at = np.searchsorted(laid, found[:, 0], side="right") - 1
    where = begin[at] + found[:, 0] - laid[at]
    owner = text[where]
    rows = np.stack([where - first[owner], found[:, 1], found[:, 2]], axis=1)
    rank = np.lexsort((rows[:, 2], rows[:, 0], owner))
    rows, owner = rows[rank], owner[rank]
    edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
    for lo, hi in zip(edges[:-1], edges[1:]):
        out[owner[lo]] = rows[lo:hi]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words, joined by blanks, without those that a run holds after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def with_runs(documents: DataFrame, text_column: str = "text", least: int = 12) -> DataFrame:
    """All rows and columns with ``runs`` (start, length and period in words) and ``collapsed``.

    Runs are ordered by start, then period. ``collapsed`` has the words that stay, joined by one blank. A null or empty
    text, or one without words, has no runs and an empty text in ``collapsed``. Rows that repeat have the same result.
    Columns of these two names are replaced, others stay, whatever their names. An empty table gives an empty result.
    """
    ready(documents.sparkSession)

    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = texts.to_list()
            for lo, hi in in_pieces(texts):
                words = [words_of(t) for t in texts[lo:hi]]
                found = runs_of(words, least)
                yield pd.DataFrame({
                    "runs": [[{"start": s, "length": n, "period": q} for s, n, q in f.tolist()] for f in found],
                    "collapsed": [collapsed(w, f) for w, f in zip(words, found)],
                })

    made = fresh(documents, "run_result")
    stay = [F.col(f"`{c}`") for c in documents.columns if c not in ("runs", "collapsed")]
    return documents.select(*stay, run(whole_text(text_column)).alias(made)).select(*stay, f"{made}.*")
