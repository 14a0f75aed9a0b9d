"""Token ids of whole texts, with every distinct word tokenized once.

The byte-level vocabulary cuts a text into words by a fixed pattern and merges bytes within
words only, so a word always gets the same ids. Here the pattern is applied to a whole batch
at once in numpy, words are told apart by a 64-bit hash, their length and ends, and only words not met before in
this process go to the tokenizer. Its answers are kept in tables of bounded size. A text that
holds a special token is left to the tokenizer as a whole, and so is one with a code point that Python's
Unicode tables do not know: the tokenizer's may be newer and take it for a letter or number.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from tokenizers import Tokenizer

from gridmarts.llm.shingles import mix, powers

LETTER, NUMBER, SPACE, OTHER, UNASSIGNED = 0, 1, 2, 3, 4
# The endings that the pattern splits off after an apostrophe.
_SHORT = ("s", "t", "d", "m")
_LONG = ("re", "ve", "ll")

_UNKNOWN = 255
_classes = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
_SPREAD = mix(np.arange(1, 0x10001, dtype=np.uint64))


def classes(codes: np.ndarray) -> np.ndarray:
    """The class of each code point: letter, number, white space, anything else, not assigned here."""
    kind = _classes[codes]
    if (kind == _UNKNOWN).any():
        for c in np.unique(codes[kind == _UNKNOWN]).tolist():
            category = unicodedata.category(chr(c))
            first = "Cn" if category == "Cn" else category[0]
            blank = first == "Z" or 0x09 <= c <= 0x0D or c == 0x85
            _classes[c] = SPACE if blank else {"L": LETTER, "N": NUMBER, "Cn": UNASSIGNED}.get(first, OTHER)
        kind = _classes[codes]
    return kind


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stay as
    they are, the others follow from code point 256 on."""
    stay = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(stay)]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(moved)}


def word_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a word of the pattern begins. ``first`` is true where a text begins."""
    kind = classes(codes)
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=bool)
    before = np.r_[np.uint8(9), kind[:-1]]
    before[first] = 9
    change = kind != before
    is_blank = codes == 0x20
    # a single blank before a letter, number or other character belongs to that word, and the
    # last character of a longer run of white space does so if it is a blank, else stands alone
    follows = np.r_[kind[1:], np.uint8(9)]
    follows[np.r_[first[1:], True]] = 9
    run_end = (kind == SPACE) & (follows != SPACE)
    splits = run_end & (follows != 9)  # a run at the end of a text stays whole
    starts = change.copy()
    starts[splits] = True
    # the character after a blank is no start of its own
    joined = np.zeros(n, dtype=bool)
    joined[1:] = splits[:-1] & is_blank[:-1]
    starts &= ~joined
    starts |= first
    _contractions(codes, kind, first, starts)
    return starts


def _contractions(codes: np.ndarray, kind: np.ndarray, first: np.ndarray, starts: np.ndarray) -> None:
    """Words 's, 't, 're and so on begin at an apostrophe that begins a word; they end there, too."""
    n = len(codes)
    for at in np.flatnonzero((codes == 0x27) & starts):
        tail = ""
        for c in codes[at + 1 : at + 3]:
            if first[at + 1 + len(tail)]:
                break
            tail += chr(c)
        size = 2 if tail[:1] in _SHORT and tail else 3 if tail in _LONG else 0
        if not size:
            continue
        starts[at + 1 : at + size] = False
        end = at + size
        if end < n and not first[end]:
            # what follows begins a word unless it is the blank's own start already
            starts[end] = True
        # an apostrophe and more others are one word; here the run was cut by a letter, so only
        # the letters after the ending start anew


class WordCache:
    """Ids of words by hash: sorted tables, and one flat array of ids."""

    def __init__(self, path: str, most: int = 500_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans(byte_letters())
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.low = np.zeros(0, dtype=np.uint64)
        self.high = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def direct(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer gives them without special tokens added."""
        plain = [i for i, t in enumerate(texts) if t and not any(s in t for s in self.special)]
        plain = self._known(texts, plain)
        out = [np.zeros(0, dtype=np.uint32)] * len(texts)
        chosen = set(plain)
        for i, t in enumerate(texts):
            if t and i not in chosen:
                out[i] = self.direct(t)
        if plain:
            for i, ids in zip(plain, self._plain([texts[i] for i in plain])):
                out[i] = ids
        return out

    def _known(self, texts: list[str], plain: list[int]) -> list[int]:
        """Those of the texts ``plain`` whose code points are all assigned."""
        codes = np.frombuffer("".join(texts[i] for i in plain).encode("utf-32-le"), dtype=np.uint32)
        odd = np.flatnonzero(classes(codes) == UNASSIGNED)
        if not len(odd):
            return plain
        ends = np.cumsum([len(texts[i]) for i in plain])
        left = set(np.searchsorted(ends, odd, side="right").tolist())
        return [i for k, i in enumerate(plain) if k not in left]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        text_at = np.cumsum([0, *(len(t) for t in texts)])
        first = np.zeros(len(codes), dtype=bool)
        first[text_at[:-1]] = True
        begin = np.flatnonzero(word_starts(codes, first))
        end = np.r_[begin[1:], len(codes)]
        up, down = powers(len(codes))
        total = np.zeros(len(codes) + 1, dtype=np.uint64)
        wide = codes > 0xFFFF
        spread = _SPREAD[np.where(wide, 0, codes)] if wide.any() else _SPREAD[codes]
        if wide.any():
            spread[wide] = mix(codes[wide].astype(np.uint64) + np.uint64(1))
        np.cumsum(np.multiply(spread, up, out=spread), out=total[1:])
        low = mix((total[end] - total[begin]) * down[begin])
        # the second hash is what can be had without another pass: length, first and last character
        high = (end - begin).astype(np.uint64) << np.uint64(42)
        high ^= codes[begin].astype(np.uint64) << np.uint64(21) ^ codes[end - 1]
        order = np.argsort(low)
        ranked = low[order]
        fresh = np.r_[True, ranked[1:] != ranked[:-1]]
        where = order[fresh]
        entry = self._entries(ranked[fresh], high[where], begin[where], end[where], joined)
        back = np.empty(len(low), dtype=np.int64)
        back[order] = np.cumsum(fresh) - 1
        size, at = self.size[entry][back], self.at[entry][back]
        token_at = np.r_[0, np.cumsum(size)]
        index = np.arange(token_at[-1]) + np.repeat(at - token_at[:-1], size)
        ids = self.ids[index]
        cuts = token_at[np.searchsorted(begin, text_at)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _entries(self, low, high, begin, end, joined) -> np.ndarray:
        """Where each of these words is in the tables; new words are added first."""
        if len(self.low) + len(low) > self.most and len(self.low):
            self.clear()
        at = np.searchsorted(self.low, low)
        at[at == len(self.low)] = 0
        found = (self.low[at] == low) & (self.high[at] == high) if len(self.low) else np.zeros(len(low), dtype=bool)
        new = np.flatnonzero(~found)
        if len(new):
            self._add(low[new], high[new], [joined[begin[i] : end[i]] for i in new])
            at = np.searchsorted(self.low, low)
        return at

    def _add(self, low, high, words: list[str]) -> None:
        coded = [w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) for w in words]
        encoded = [[t.id for t in self.tokenizer.model.tokenize(w)] for w in coded]
        size = np.array([len(e) for e in encoded], dtype=np.int64)
        at = len(self.ids) + np.r_[0, np.cumsum(size)[:-1]]
        self.ids = np.concatenate([self.ids, np.fromiter((i for e in encoded for i in e), dtype=np.uint32, count=size.sum())])
        every = np.concatenate([self.low, low])
        order = np.argsort(every, kind="stable")
        self.low = every[order]
        self.high = np.concatenate([self.high, high])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]


_caches: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    """One cache per process and vocabulary."""
    if path not in _caches:
        _caches[path] = WordCache(path)
    return _caches[path]
