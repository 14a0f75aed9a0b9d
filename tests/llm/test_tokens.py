"""Token files and packing: round trips and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridmarts.llm import token_files, two_fit_packing
from gridmarts.llm.common import new_folder
from gridmarts.llm.pretokens import WordCache

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_word_cache_equals_the_tokenizer(tokenizer):
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "'re", "'ll", "1", "22", "½", "é", "ß", "Ⅷ", "　", "\xa0", "!",
            "''", "😀", "中", "́", "'t ", "\r\n", "\x85", "​", "don't", "A", "'S", "\x1c", " 's", "<|endoftext|>"]
    cache = WordCache(VOCABULARY, most=50)  # small, so that it is emptied now and then
    for _ in range(1_500):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3)]
        for text, ids in zip(texts, cache.encode(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_files_hold_what_was_written(spark, awkward, nothing, tokenizer):
    folder = new_folder(spark, "files")
    manifest = token_files.write_files(awkward.repartition(3), folder, VOCABULARY, end_id=2)
    got = token_files.read_files(spark, folder).collect()
    rows = awkward.collect()
    coded = {}
    for r in rows:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        coded.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    keys = [(r["id"] is not None, r["id"] or 0) for r in got]
    assert keys == sorted(keys)  # null ids first, then ascending
    at, seen = 0, {}
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        seen.setdefault(r["id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in coded.items()}
    assert manifest.agg({"tokens": "sum"}).first()[0] == at
    empty = token_files.round_trip(nothing, VOCABULARY, 2)
    assert empty.count() == 0 and "doc_id" in empty.columns


def least_sequences(lengths, size):
    """Exact, by trying where each piece can go."""
    best = len(lengths)
    ordered = sorted(lengths, reverse=True)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(ordered):
            best = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins) if b + ordered[i] <= size}.values():
            place(i + 1, [*bins[:k], bins[k] + ordered[i], *bins[k + 1 :]])
        place(i + 1, [*bins, ordered[i]])

    place(0, [])
    return best


def test_plans_are_close_to_the_least():
    rng = random.Random(3)
    extra = 0
    for _ in range(60):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        counts = {n: lengths.count(n) for n in lengths}
        patterns = two_fit_packing.plan(counts, 20)
        used = [n for times, items in patterns for n in items * times]
        assert sorted(used) == sorted(lengths) and all(sum(items) <= 20 for _, items in patterns)
        extra += sum(t for t, _ in patterns) - least_sequences(lengths, 20)
    assert extra <= 3


def test_two_smaller_pieces_take_the_place_of_one():
    # greedy: 6 + 3, and 2 are left over; two pieces of 2 fill the gap of 4 that 3 would leave
    assert two_fit_packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


def test_many_pieces_need_few_patterns():
    rng = random.Random(4)
    counts = {n: rng.randint(1, 100_000) for n in range(1, 2049)}
    patterns = two_fit_packing.plan(counts, 2048)
    total = sum(n * c for n, c in counts.items())
    sequences = sum(t for t, _ in patterns)
    assert len(patterns) < 20_000 and sequences <= 1.02 * total / 2048 + 1
    where = two_fit_packing.slots(patterns)
    for n, part in where.groupby("length"):
        part = part.sort_values("first")
        assert part["first"].iloc[0] == 0 and part["last"].iloc[-1] == counts[n]
        assert (part["first"].to_numpy()[1:] == part["last"].to_numpy()[:-1]).all()


def test_cuts():
    assert two_fit_packing.cut(0, 10) == [(0, 0)] and two_fit_packing.cut(10, 10) == [(0, 10)]
    assert two_fit_packing.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert two_fit_packing.cut(20, 10) == [(0, 10), (10, 10)]


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_is_gapless_and_whole(spark, awkward, nothing, tokenizer, size):
    got = two_fit_packing.packed(awkward, VOCABULARY, end_id=0, size=size).toPandas()
    whole = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in awkward.collect())
    assert got["length"].sum() == whole and (got["length"] <= size).all()
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        ends = part["length"].cumsum()
        assert part["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= size
    assert two_fit_packing.packed(nothing, VOCABULARY).count() == 0


def test_words_with_characters_of_newer_unicode_versions(tokenizer):
    rng = random.Random(8)
    bits = ["a", "Ᲊ", "Ɤ", "\U000105c0", "\U0001e5f0", "\U0001e5f1", "͸", "￿", " ", "!", "1", "'s"]
    cache = WordCache(VOCABULARY)
    for _ in range(300):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(3)] + ["plain text"]
        for text, ids in zip(texts, cache.encode(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_other_stores_are_read_in_ranges(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * (i % 5)) for i in range(100)], "doc_id long, text string").coalesce(1)
    manifest = token_files.write_files(docs, str(tmp_path), VOCABULARY, end_id=2).toPandas()
    whole = [r for f in token_files._read_shards(str(tmp_path))([manifest]) for r in f.itertuples(index=False, name=None)]
    taken = []

    class Opened:
        def __init__(self, file):
            self.file, self.close = file, file.close

        def read_at(self, n, at):
            taken.append(n)
            return self.file.read_at(n, at)

    class Store:  # not a LocalFileSystem, and without whole reads
        def __init__(self, inner):
            self.get_file_info, self.inner = inner.get_file_info, inner

        def open_input_file(self, path):
            return Opened(self.inner.open_input_file(path))

    inner, path = token_files.place(str(tmp_path))
    monkeypatch.setattr(token_files, "place", lambda folder: (Store(inner), path))
    got = token_files._read_shards("x", rows=10, most=25)([manifest])
    assert [r for f in got for r in f.itertuples(index=False, name=None)] == whole and len(whole) == 100
    assert max(taken) <= 8 * 11
