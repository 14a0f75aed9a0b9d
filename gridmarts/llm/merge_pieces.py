"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding starts from the characters of the normalised text. An agenda holds every pair of adjacent symbols
that together are a piece, ordered by the piece's score, the leftmost of equals first. The best pair is merged, its
new neighbours go on the agenda, and entries whose symbols have changed since are passed over when they
come up. What is no piece in the end is written as its UTF-8 bytes, or as the unknown id if the vocabulary has no bytes.

Two characters that are neighbours in no piece of the vocabulary are never merged, so a text falls apart there. It is
cut into chunks (marks and a word, or characters that no longer piece has), which are looked up in a table; the table is
bounded: when it is full, only chunks that came more than once stay, at most half of it. A worker keeps its table from task to task.
The chunks that a batch brings for the first time are merged together, those of one length as the columns of a numpy table,
with each column's agenda beside it; long ones have a heap of their own. In every Arrow batch the chunks met for the first time go to the sentencepiece library in one call, and the
job stops if its ids or its decoded text differ. ``compared`` does the same for whole texts.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from gridmarts.llm.common import fresh, ready, whole_text
from gridmarts.llm.shingles import in_pieces

MARK = "▁"  # fixed value: the sign for a blank
REPLACEMENT = "�"
NONE = np.int32(1 << 30)  # the agenda's entry where two symbols make no piece


class Merger:
    """The vocabulary of a model file, given as its bytes, and its answers so far."""

    def __init__(self, model: bytes, most_characters: int = 3_000_000):
        self.library = SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        self.special = [self.library.is_control(i) or self.library.is_unknown(i) for i in range(size)]
        byte = [self.library.is_byte(i) for i in range(size)]
        self.names = [self.library.id_to_piece(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.names) if not self.special[i] and not byte[i]}
        self.scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(size) if byte[i]}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = self.library.unk_id()
        self.unknown_text = self.library.decode([self.unknown])
        self.marks = self.library.normalize("a").startswith(MARK)  # a mark is put before the text
        plain = [not special and not b for special, b in zip(self.special, byte)]
        self.shown = [name.replace(MARK, " ") if p else None for name, p in zip(self.names, plain)]
        # two characters that are neighbours in no piece are never merged
        neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        joined = {c for pair in neighbours for c in pair} - {MARK}
        cuts = not any(a != MARK and b == MARK for a, b in neighbours)
        kind = "".join(re.escape(c) for c in sorted(joined))
        # marks and a word, or a run of characters that are part of no longer piece
        words = f"{MARK}*[{kind}]+|" if kind else ""
        self.chunk = re.compile(f"{words}{MARK}+|[^{kind}{MARK}]+" if cuts else ".+", re.DOTALL)
        self._pair_table()
        self._character_tables()
        self.most = most_characters
        self._forget()

    def _pair_table(self) -> None:
        """Every way to make a piece of two symbols, as sorted keys with the piece and its score."""
        known = {p: i for p, i in self.ids.items()}
        made = [
            (self._symbol(p[:k]) << 21 | self._symbol(p[k:]), i)
            for p, i in known.items()
            for k in range(1, len(p))
            if (k == 1 or p[:k] in known) and (len(p) - k == 1 or p[k:] in known)
        ]
        table = np.array(sorted(made), dtype=np.int64).reshape(-1, 2)
        scores = np.array([self.library.get_score(i) for i in range(len(self.names))], dtype=np.float64)
        _, rank = np.unique(-scores, return_inverse=True)  # the best score is 0, equal ones are alike
        self.keys = np.r_[table[:, 0], np.int64(1) << 62]
        self.made = np.r_[table[:, 1], 0].astype(np.int32)
        self.ranks = np.r_[rank[table[:, 1]], 0].astype(np.int32)

    def _character_tables(self) -> None:
        """The symbol of every character, and the characters that every id shows (none where it has no text of its own)."""
        self.of_character = np.arange(0x110000, dtype=np.int32) + np.int32(len(self.names) + 1)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_character[ord(piece)] = i
        self.shown_length = np.array([-1 if x is None else len(x) for x in self.shown], dtype=np.int64)
        self.shown_end = np.cumsum(np.maximum(self.shown_length, 0))
        self.shown_codes = _codes("".join(x or "" for x in self.shown))

    def _symbol(self, text: str) -> int:
        """A piece's id; a character that is no piece has a number beyond all ids."""
        found = self.ids.get(text)
        return len(self.names) + 1 + ord(text) if found is None else found

    def _forget(self) -> None:
        self.known = _Answers(self)
        self.chunks, self.held, self.odd = [], 0, {}  # odd: the decoded text of chunks that do not decode to themselves
        self.flat = np.zeros(0, dtype=np.int32)
        self.start, self.count, self.uses = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def _make_room(self) -> None:
        """Keep the chunks that came more than once, the most frequent first, in at most half the table."""
        often = np.flatnonzero(self.uses > 1)
        often = often[np.argsort(-self.uses[often], kind="stable")]
        sizes = np.fromiter((len(self.chunks[i]) for i in often.tolist()), dtype=np.int64, count=len(often))
        stay = np.sort(often[np.cumsum(sizes) <= self.most // 2])
        chunks, odd, start, count, uses = self.chunks, self.odd, self.start, self.count, self.uses
        flat = _stretches(self.flat, start[stay], count[stay])
        self._forget()
        self.chunks = [chunks[i] for i in stay.tolist()]
        self.known.update(zip(self.chunks, range(len(stay))))
        self.odd = {k: odd[i] for k, i in enumerate(stay.tolist()) if i in odd}
        self.held = sum(map(len, self.chunks))
        self.flat, self.count, self.uses = flat, count[stay], uses[stay] // 2
        self.start = np.cumsum(self.count) - self.count

    def merged(self, text: str) -> list[str]:
        """The symbols that are left when no adjacent pair is a piece."""
        symbols: list[str | None] = list(text)
        agenda = [(-self.scores[p], i, i + 1, p) for i, p in enumerate(map(add, text, text[1:])) if p in self.scores]
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue  # one of the two has changed
            symbols[left], symbols[right] = piece, None
            ahead, behind = before[left], after[right]
            after[left] = behind
            if behind >= 0:
                before[behind] = left
                joint = piece + symbols[behind]
                if joint in self.scores:
                    heapq.heappush(agenda, (-self.scores[joint], left, behind, joint))
            if ahead >= 0:
                joint = symbols[ahead] + piece
                if joint in self.scores:
                    heapq.heappush(agenda, (-self.scores[joint], ahead, left, joint))
        return [s for s in symbols if s]

    def pieces(self, text: str) -> list[int]:
        """The ids of a normalised text or chunk."""
        return self._written([self._symbol(s) for s in self.merged(text)])

    def _written(self, symbols: list[int]) -> list[int]:
        """Ids for symbols: what is no piece becomes its bytes or the unknown id, once for neighbours."""
        out: list[int] = []
        for symbol in symbols:
            if symbol < len(self.names):
                out.append(symbol)
            elif self.bytes:
                out += (self.bytes[b] for b in chr(symbol - len(self.names) - 1).encode("utf-8"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _looked_up(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each pair makes, and its entry on the agenda: the rank of its score, then the pair's place in the text."""
        key = left.astype(np.int64) << 21 | right
        at = np.searchsorted(self.keys, key)
        return self.made[at], np.where(self.keys[at] == key, self.ranks[at] << 6 | place, NONE)

    def merged_together(self, texts: list[str]) -> np.ndarray:
        """The symbols of many texts of one length below 64, a row each, with -1 at places that were merged into others.

        Each text is a column with an agenda of its own, and every step merges the best pair of every column: the
        left symbol becomes the piece, the right one goes, and the neighbours' pairs are looked up anew.
        """
        wide = len(texts[0])
        symbols = np.full((wide + 1, len(texts)), len(self.names), dtype=np.int32)  # the last row is no symbol
        symbols[:-1] = self.of_character[_codes("".join(texts)).reshape(len(texts), wide).T]
        place = np.arange(wide, dtype=np.int32)[:, None]
        made, agenda = self._looked_up(symbols[:-1], symbols[1:], place)
        made, agenda = (np.concatenate([x, x[:1]]) for x in (made, agenda))
        agenda[-1] = NONE
        after = np.repeat(np.arange(1, wide + 2)[:, None], len(texts), axis=1)
        before = np.repeat(np.r_[wide, np.arange(wide)][:, None], len(texts), axis=1)
        out, columns = np.empty((len(texts), wide), dtype=np.int32), np.arange(len(texts))
        while True:
            best = agenda.min(axis=0)  # the leftmost of equals
            own = np.flatnonzero(best < NONE)
            if len(own) <= len(columns) // 2:  # leave out the columns that are done
                out[columns] = symbols[:-1].T
                if not len(own):
                    return out
                symbols, made, agenda, after, before = (x[:, own] for x in (symbols, made, agenda, after, before))
                best, columns, own = best[own], columns[own], np.arange(len(own))
            left = (best[own] & 63).astype(np.int64)
            right, piece = after[left, own], made[left, own]
            behind, ahead = after[right, own], before[left, own]
            symbols[left, own], symbols[right, own], agenda[right, own] = piece, -1, NONE
            after[left, own], before[behind, own] = behind, left
            at, twice = np.r_[ahead, left], np.r_[own, own]
            made[at, twice], agenda[at, twice] = self._looked_up(
                np.r_[symbols[ahead, own], piece], np.r_[piece, symbols[behind, own]], at
            )

    def decode(self, ids: list[int], begins: bool = True) -> str:
        """The text of ids. Where a text ``begins``, the mark that was put before it is left out."""
        if not begins:
            try:
                return "".join(map(self.shown.__getitem__, ids))
            except TypeError:  # bytes or special ids among them
                pass
        out, raw = [], bytearray()
        begins = begins and self.marks
        for i in [*ids, None]:
            if i is not None and i in self.byte_of:
                raw.append(self.byte_of[i])
                begins = False
                continue
            if raw:
                out.append(_characters(bytes(raw)))
                raw.clear()
            if i == self.unknown:
                out.append(self.unknown_text)
                begins = False
            elif i is not None and not self.special[i]:
                name = self.names[i]
                out.append((name[1:] if begins and name.startswith(MARK) else name).replace(MARK, " "))
                begins = False
        return "".join(out)

    def _learn(self, short: int = 40, rows: int = 4096) -> None:
        """Encode and decode the chunks asked for since the last time, and ask the library, too."""
        old = len(self.start)
        new = self.chunks[old:]
        if not new:
            return
        length = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        order = np.argsort(length, kind="stable")
        found, counts = [], []  # in this order
        edges = np.flatnonzero(np.r_[True, np.diff(length[order]) > 0, True])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for at in range(lo, hi, rows):
                part = order[at : min(at + rows, hi)].tolist()
                texts = [new[i] for i in part]
                ids, count = self._together(texts) if len(texts[0]) <= short else _joined(map(self.pieces, texts))
                for k in np.flatnonzero(~self._plain(texts, ids, count)).tolist():
                    end = count[: k + 1].sum()
                    text = self.decode(ids[end - count[k] : end].tolist(), begins=False)
                    if text != texts[k].replace(MARK, " "):
                        self.odd[old + part[k]] = text
                found.append(ids)
                counts.append(count)
        count = np.concatenate(counts)
        start = np.empty((2, len(new)), dtype=np.int64)
        start[:, order] = np.cumsum(count) - count + len(self.flat), count
        self.flat = np.concatenate([self.flat, *found])
        self.start, self.count = np.r_[self.start, start[0]], np.r_[self.count, start[1]]
        self.uses = np.r_[self.uses, np.zeros(len(new), dtype=np.int64)]
        self.held += int(length.sum())
        self._ask(old, new)

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts of one length, one text after the other, and how many each has."""
        symbols = self.merged_together(texts)
        if symbols.max() > len(self.names):  # characters that are no pieces
            return _joined(self._written([s for s in row if s >= 0]) for row in symbols.tolist())
        stay = symbols >= 0
        return symbols[stay], stay.sum(axis=1)

    def _plain(self, texts: list[str], ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Which texts, all of one length and with blanks for marks, are the pieces of their ids."""
        wide = len(texts[0])
        length = self.shown_length[ids]
        edges = np.cumsum(count) - count
        plain = (np.add.reduceat(length, edges) == wide) & (np.minimum.reduceat(length, edges) >= 0)
        ids = ids[np.repeat(plain, count)]
        shown = _stretches(self.shown_codes, self.shown_end[ids] - self.shown_length[ids], self.shown_length[ids])
        own = _codes("".join(texts).replace(MARK, " ")).reshape(len(texts), wide)
        plain[plain] = (shown.reshape(-1, wide) == own[plain]).all(axis=1)
        return plain

    def _ask(self, old: int, new: list[str]) -> None:
        """Compare the ids and the decoded text of new chunks with the library's."""
        # the library puts the first mark itself: a chunk without one, or a lone mark, can't be asked for where it does
        asked = [i for i, c in enumerate(new) if not self.marks or (c[0] == MARK and len(c) > 1)]
        if not asked:
            return
        bare = [new[i][1:] if self.marks else new[i] for i in asked]
        theirs = self.library.encode(bare, num_threads=1)
        ids, count = _joined(theirs)
        at = np.array(asked) + old
        same = np.array_equal(count, self.count[at]) and np.array_equal(ids, _stretches(self.flat, self.start[at], self.count[at]))
        shown = [text.replace(MARK, " ") for text in bare]
        for k in np.flatnonzero(np.isin(at, list(self.odd))).tolist():
            shown[k] = self.odd[old + asked[k]][1:] if self.marks else self.odd[old + asked[k]]
        texts = self.library.decode(theirs, num_threads=1)
        if same and texts == shown:
            return
        for i, ids, text, own in zip(asked, theirs, texts, shown):
            at = self.start[old + i]
            if ids != self.flat[at : at + self.count[old + i]].tolist() or text != own:
                raise ValueError(f"the library differs on {new[i]!r}")

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """(ids, decoded text) of each text."""
        if self.held > self.most:
            self._make_room()
        whole = [self.library.normalize(t) for t in texts]
        cut = [self.chunk.findall(t) for t in whole]
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=sizes.sum())
        try:
            self._learn()
        except BaseException:
            self._forget()  # the table has chunks without an answer
            raise
        self.uses += np.bincount(number, minlength=len(self.uses))
        n = self.count[number]
        flat = _stretches(self.flat, self.start[number], n)
        odd = np.zeros(len(self.start), dtype=bool)
        odd[list(self.odd)] = True
        odd = odd[number]
        edges = np.r_[0, np.cumsum(sizes)]
        at = np.r_[0, np.cumsum(n)][edges]
        out = []
        for i, text in enumerate(whole):
            if odd[edges[i] : edges[i + 1]].any():
                own = number[edges[i] : edges[i + 1]].tolist()
                text = "".join([self.odd[k] if k in self.odd else self.chunks[k].replace(MARK, " ") for k in own])
            else:
                text = text.replace(MARK, " ")  # what each of its chunks decodes to
            # the mark was put there by the normaliser
            text = text[1:] if self.marks and whole[i].startswith(MARK) else text
            out.append((flat[at[i] : at[i + 1]], text))
        return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _stretches(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """values[start : start + count] of every stretch, one after the other."""
    ends = np.cumsum(count)
    return values[np.repeat(start - (ends - count), count) + np.arange(count.sum())]


def _joined(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, one after the other, and how many each has."""
    lists = list(lists)
    count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=count.sum()), count


class _Answers(dict):
    """Chunk -> its number. One that is asked for the first time gets the next."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger = merger

    def __missing__(self, chunk: str) -> int:
        self.merger.chunks.append(chunk)
        self[chunk] = found = len(self.merger.chunks) - 1
        return found


def _characters(raw: bytes) -> str:
    """Bytes as UTF-8; each one that isn't part of a character becomes a replacement sign of its own."""
    out, at = [], 0
    while at < len(raw):
        wide = next((w for w in (1, 2, 3, 4) if _is_character(raw[at : at + w], w)), 0)
        out.append(raw[at : at + wide].decode("utf-8") if wide else REPLACEMENT)
        at += wide or 1
    return "".join(out)


def _is_character(raw: bytes, wide: int) -> bool:
    if len(raw) != wide:
        return False
    try:
        return len(raw.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, read on the driver (it is about as large as the vocabulary) and sent with the tasks."""
    with open(path, "rb") as file:
        return file.read()


_kept: dict[bytes, Merger] = {}


def _merger_of(model: bytes) -> Merger:
    """The worker's own merger, which later tasks with the same model go on with."""
    if model not in _kept:
        _kept.clear()
        _kept[model] = Merger(model)
    return _kept[model]


def encoded(documents: DataFrame, model: str, text_column: str = "text") -> DataFrame:
    """All rows and columns with ``piece_ids``, the ids of the whole text, and ``decoded``, their text.

    Null counts as empty; an empty text has no ids and decodes to an empty text. Rows that repeat are encoded
    alike. Columns of these two names are replaced, others stay, whatever their names. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    ready(spark)
    model = model_bytes(spark, model)

    @F.pandas_udf("piece_ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        merger = _merger_of(model)
        for texts in batches:
            texts = texts.to_list()
            for lo, hi in in_pieces(texts):
                found = merger.encode(texts[lo:hi])
                yield pd.DataFrame({
                    "piece_ids": [ids for ids, _ in found],
                    "decoded": [text for _, text in found],
                })

    made = fresh(documents, "pieces")
    stay = [F.col(f"`{c}`") for c in documents.columns if c not in ("piece_ids", "decoded")]
    return documents.select(*stay, run(whole_text(text_column)).alias(made)).select(*stay, f"{made}.*")


def compared(documents: DataFrame, model: str, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``encoded`` with ``same``: true if the library's ids and text of the whole text are these."""
    spark = documents.sparkSession
    model_file = model_bytes(spark, model)

    @F.pandas_udf("boolean")
    def same(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        library = SentencePieceProcessor(model_proto=model_file)
        for texts, ids, decoded in batches:
            theirs = library.encode(texts.to_list(), num_threads=1)
            yield pd.Series([t == list(i) and library.decode(t) == d for t, i, d in zip(theirs, ids, decoded)], dtype=bool)

    return encoded(documents, model, text_column).withColumn("same", same(whole_text(text_column), "piece_ids", "decoded"))
