"""Word shingles of texts as sorted arrays of 64-bit hashes, in numpy.

A text is lower-cased in A-Z only and cut at ASCII white space (space, tab to carriage
return), which is what ``bytes.lower`` and a table of six bytes do. A text of fewer words
than a shingle has is one shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[_GAP] = 0
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: int, size: int) -> np.ndarray:
    row = np.full(size, base, dtype=np.uint64)
    row[0] = 1
    return np.cumprod(row, dtype=np.uint64)


def powers(n: int, kept: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64. Tables beyond ``kept`` entries are made anew each time."""
    back = pow(_BASE, -1, 1 << 64)
    if n > kept:
        return _powers_of(_BASE, n), _powers_of(back, n)
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers.update(up=_powers_of(_BASE, size), down=_powers_of(back, size))
    return _powers["up"][:n], _powers["down"][:n]


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes one text after the other, repeats included, and where each text starts.

    The second array has an entry more than there are texts.
    """
    coded = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    raw = np.frombuffer(b" ".join([*coded, b" "]), dtype=np.uint8)
    text_end = np.cumsum([len(c) + 1 for c in coded])
    gap = np.empty(len(raw) + 1, dtype=bool)
    gap[0], gap[1:] = True, _GAP[raw]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    ends = np.flatnonzero(~gap[:-1] & gap[1:])  # a gap always follows
    up, down = powers(len(raw))
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * up, out=total[1:])
    word = mix((total[ends] - total[starts]) * down[starts])
    first = np.searchsorted(starts, np.r_[0, text_end])  # of each text, its first word
    count = np.diff(first)

    run = word.copy()
    for j in range(1, words):
        run[:-j] = run[:-j] + word[j:] * np.uint64(pow(_BASE, 2 * j + 1, 1 << 64))
    run = mix(run)
    out_count = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = np.r_[0, np.cumsum(out_count)]
    index = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], out_count)
    out = run[index]
    for i in np.flatnonzero((count > 0) & (count < words)):
        scale = np.uint64(2 * count[i] + 1) * np.arange(3, 3 + 2 * count[i], 2, dtype=np.uint64)
        out[at[i]] = mix(np.array([(word[first[i] : first[i] + count[i]] * scale).sum()], dtype=np.uint64))[0]
    return out, at


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    every, at = shingles(texts, words)
    return [np.unique(every[a:b]) for a, b in zip(at[:-1], at[1:])]


def in_pieces(texts: list[str], most: int = 2_000_000):
    """Slices of the list with about so many characters each, so that arrays stay small."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)
