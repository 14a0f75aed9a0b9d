"""Repeated passages by a sorted array of suffixes.

A string of ``length`` bytes that starts at two places is removed at both. Sorting every
suffix of the corpus would move hundreds of bytes per byte of text, so the array is a sparse one,
chosen by content: in every window of ``length`` bytes the place of the smallest hash of
``anchor`` bytes is its anchor. Equal windows have their anchor at the same offset, so only
suffixes that start at anchors are sorted, about two for every ``length`` bytes.

1. Suffix sort. Splitters, sampled from texts all over the table by their hashes, deal the suffixes by their leading
   ``anchor`` bytes; each bucket is sorted by a multikey quicksort on 8-byte tokens and
   neighbours are compared. Splitters have all the bytes that are compared, so suffixes that
   agree never part at a boundary. A task that has met a suffix repeatedly sends it on once,
   so a passage that a third of all documents share does not fill a bucket.
2. Extension. An anchor whose leading bytes occur once settles all its windows. For the others
   the windows are taken together: all are repeated if the stretch they cover occurs
   again with the same anchor, none is if the part common to all of them does not. What is left
   open is cut into cells of ``cell`` offsets and judged again, then window by window. Stretches are
   compared by 128-bit fingerprints, counted with partial aggregation, and the frequent ones are broadcast,
   so no large group of equal stretches is ever brought together.
3. The bytes of all repeated windows are the spans to remove, judged on the input as it is.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import Scratch, fresh, ready, scratch, whole_text
from gridmarts.llm.shingles import in_pieces, mix, powers

CHUNK = 1 << 22  # bytes of a document worked on at once; positions in it fit 24 bits
FREQUENT = 1_000  # rows of a key that one task may take in any case
KEYS = 10_000  # beyond, a key is broadcast if it has more than one row in so many
_ONE = mix(np.arange(1_001, 1_257, dtype=np.uint64))
_TWO = mix(np.arange(9_001, 9_257, dtype=np.uint64))
FOUND = "doc long, lo long, hi long, s long, gram long, u1 long, u2 long"
SPANS = "array<struct<start:long,end:long>>"


class Hashes:
    """Hashes of any stretch of some bytes, from running sums."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros((2, len(raw) + 1), dtype=np.uint64)
        for row, table in zip(self.sums, (_ONE, _TWO)):
            np.cumsum(table[raw] * up[:-1], out=row[1:])

    def of(self, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[which][hi] - self.sums[which][lo]) * self.down[lo] + (hi - lo).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64)


def anchors(grams: np.ndarray, windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: first window, last window, anchor.

    Window x has the grams x..x+width-1; its anchor is the smallest, the leftmost of equals.
    """
    place = np.arange(len(grams), dtype=np.uint64)
    keys = (grams & ~np.uint64(0xFFFFFF)) | place
    rows = -(-len(keys) // width)
    full = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[: len(keys)] = keys
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows])
    at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return lo, np.r_[lo[1:], windows] - 1, at[lo]


def multikey_order(tokens: np.ndarray, small: int = 4096) -> np.ndarray:
    """The order of the rows, by a multikey quicksort on their 64-bit tokens."""
    order = np.arange(len(tokens))
    work = [(0, len(tokens), 0)]
    while work:
        lo, hi, depth = work.pop()
        if hi - lo < 2 or depth == tokens.shape[1]:
            continue
        part = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = part[np.lexsort(tokens[part, depth:].T[::-1])]
            continue
        key = tokens[part, depth]
        pivot = np.sort(key[:: max(1, len(key) // 31)])[min(15, (len(key) - 1) // 2)]
        less, same = part[key < pivot], part[key == pivot]
        order[lo:hi] = np.concatenate([less, same, part[key > pivot]])
        a, b = lo + len(less), lo + len(less) + len(same)
        work += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def _tokens(leads: list[bytes]) -> np.ndarray:
    """Each row's bytes as big-endian 64-bit numbers, so that order is that of the bytes."""
    wide = -(-len(leads[0]) // 8) * 8
    return np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in leads), dtype=">u8").reshape(len(leads), -1).astype(np.uint64)


def _document_anchors(text: str, length: int, anchor: int):
    """Per chunk of a document: its start, bytes, hashes, and the runs of windows."""
    whole = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    for at in range(0, max(0, len(whole) - length + 1), CHUNK):
        raw = whole[at : at + CHUNK + length - 1]
        hashes = Hashes(raw)
        starts = np.arange(len(raw) - anchor + 1)
        grams = hashes.of(0, starts, starts + anchor)
        yield at, raw, hashes, grams, *anchors(grams, len(raw) - length + 1, length - anchor + 1)


def _suffixes(length: int, anchor: int, splitters: list[bytes]):
    cuts = np.array(splitters, dtype=f"S{anchor}") if splitters else None

    def run(batches):
        often = np.zeros(0, dtype=np.uint64)  # anchors this task has met twice within a slice
        for frame in batches:
            docs, texts = frame["doc"].to_numpy(), frame["text"].to_list()
            for begin, end in in_pieces(texts):
                out = []
                for doc, text in zip(docs[begin:end], texts[begin:end]):
                    for at, raw, hashes, grams, lo, hi, s in _document_anchors(text, length, anchor):
                        u1, u2 = (signed(hashes.of(k, lo, hi + length)) for k in (0, 1))
                        leads = np.lib.stride_tricks.sliding_window_view(raw, anchor)[s]
                        ids = np.full(len(s), doc)
                        out.append((ids, lo + at, hi + at, s + at, u1, u2, grams[s], leads))
                if not out:
                    continue
                *columns, gram, lead = (np.concatenate(c) for c in zip(*out))
                _, first, back, n = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
                leader = np.zeros(len(gram), dtype=bool)
                leader[first] = True
                known, before = n[back] > 1, np.isin(gram, often)
                often = np.union1d(often, gram[known & leader])[-2_000_000:]
                keep = leader & ~before  # suffixes to be sorted
                # what needs no sorting is known to repeat: it is dealt by its place, as many may have the same anchor
                place = columns[0].astype(np.uint64) ^ mix(columns[3].astype(np.uint64))
                bucket = signed(mix(place) >> np.uint64(20)) % (len(splitters) + 1)
                rows = np.ascontiguousarray(lead[keep])
                if cuts is not None:
                    bucket[keep] = np.searchsorted(cuts, rows.view(f"S{anchor}").ravel(), side="right")
                sent = np.full(len(gram), None, dtype=object)
                sent[keep] = [r.tobytes() for r in rows]
                made = dict(zip(("doc", "lo", "hi", "s", "u1", "u2"), columns))
                yield pd.DataFrame(made | {"gram": signed(gram), "lead": sent, "known": known | before, "bucket": bucket})

    return run


def _sort_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    repeated = frame["known"].to_numpy().copy()
    sent = np.flatnonzero(frame["lead"].notna().to_numpy())
    if len(sent):
        tokens = _tokens(frame["lead"].iloc[sent].to_list())
        order = multikey_order(tokens)
        ranked = tokens[order]
        same = (ranked[1:] == ranked[:-1]).all(axis=1)
        repeated[sent[order[1:][same]]] = True
        repeated[sent[order[:-1][same]]] = True
    return frame.loc[repeated, ["doc", "lo", "hi", "s", "gram", "u1", "u2"]]


def _sampled_splitters(docs: DataFrame, length: int, anchor: int, buckets: int, some_texts: int = 2_000) -> list[bytes]:
    """Leads of the suffixes of about ``some_texts`` different texts, cut evenly; fewer if they have fewer.

    Texts are chosen by their hash, so they come from the whole table and copies count once.
    """
    key = F.xxhash64("text")
    different = docs.agg(F.approx_count_distinct(key)).first()[0]
    chosen = F.pmod(key, F.lit(max(1, different // some_texts))) == 0

    def leads(batches):
        met = set()
        for frame in batches:
            texts = frame.loc[~frame["key"].isin(met)].drop_duplicates("key")
            met.update(texts["key"])
            found = [
                raw.tobytes()[i : i + anchor]
                for text in texts["text"]
                for _, raw, _, _, _, _, s in _document_anchors(text, length, anchor)
                for i in s[:: max(1, len(s) // 50)].tolist()
            ]
            yield pd.DataFrame({"lead": found})

    some = docs.where(chosen).select("text", key.alias("key")).mapInPandas(leads, "lead binary").distinct().toPandas()
    every = sorted(set(bytes(x) for x in some["lead"]))
    buckets = min(buckets, len(every))
    return [every[i * len(every) // buckets] for i in range(1, buckets)]


def _bytes_of(batch: pa.RecordBatch):
    """(doc, bytes, places to look at) of each row; the places are one array for each of their fields."""
    places = batch.column("places")
    inside = places.flatten()
    fields = {f.name: inside.field(f.name).to_numpy(zero_copy_only=False) for f in inside.type}
    edges = places.offsets.to_numpy() - places.offsets[0].as_py()
    has_text = "text" in batch.schema.names
    for i, doc in enumerate(batch.column("doc").to_pylist()):
        whole = np.frombuffer(batch.column("text")[i].as_buffer(), dtype=np.uint8) if has_text else None
        yield doc, whole, {name: x[edges[i] : edges[i + 1]] for name, x in fields.items()}


def _in_batches(tables, rows: int = 200_000):
    """Small tables (dicts of arrays) together, large ones in slices, as Arrow batches."""
    held, size = [], 0
    for table in tables:
        held.append(table)
        size += len(next(iter(table.values())))
        if size >= rows:
            yield from _sliced(held, rows)
            held, size = [], 0
    if size:
        yield from _sliced(held, rows)


def _sliced(held: list[dict], rows: int):
    whole = pa.table({name: np.concatenate([t[name] for t in held]) for name in held[0]})
    yield from whole.to_batches(max_chunksize=rows)


def _cells(length: int, cell: int):
    def tables(batches):
        for batch in batches:
            for doc, whole, places in _bytes_of(batch):
                lo, hi, s = places["lo"], places["hi"], places["s"]
                hashes = Hashes(whole)
                least, most = s - hi, s - lo  # offsets of the anchor in the windows
                first, last = least // cell, most // cell
                n = last - first + 1
                at = np.repeat(np.arange(len(s)), n)
                j = first[at] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                a, b = np.maximum(least[at], j * cell), np.minimum(most[at], j * cell + cell - 1)
                lo2, hi2 = s[at] - b, s[at] - a
                core = hashes.of(0, s[at] - j * cell, s[at] - (j * cell + cell - 1) + length)
                yield {
                    "doc": np.full(len(at), doc), "lo": lo2, "hi": hi2, "s": s[at], "cell": j, "core": signed(core),
                    "u1": signed(hashes.of(0, lo2, hi2 + length)), "u2": signed(hashes.of(1, lo2, hi2 + length)),
                }

    return lambda batches: _in_batches(tables(batches))


def _windows(length: int):
    def tables(batches):
        for batch in batches:
            for doc, whole, places in _bytes_of(batch):
                lo, n = places["lo"], places["hi"] - places["lo"] + 1
                x = np.unique(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
                hashes = Hashes(whole)
                for at in range(0, len(x), CHUNK):
                    y = x[at : at + CHUNK]
                    u1, u2 = (signed(hashes.of(k, y, y + length)) for k in (0, 1))
                    yield {"doc": np.full(len(y), doc), "lo": y, "u1": u1, "u2": u2}

    return lambda batches: _in_batches(tables(batches))


def _with_places(docs: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Documents with their list of places, which is stored, so that Spark knows its size."""
    lists = places.groupBy("doc").agg(F.collect_list(F.struct(*[c for c in places.columns if c != "doc"])).alias("places"))
    return docs.join(lists, "doc", how)


def _twice(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur in more than one row, and how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1")


def _marked(rows: DataFrame, wanted: DataFrame, total: int, tables: Scratch | None = None) -> DataFrame:
    """Rows with ``all``: true if their keys are in ``wanted``, null if not.

    ``wanted`` has each key once, and ``times``, at least the number of its rows; all times together are at
    most ``total``. A join by key brings all rows of a key into one task. Keys of more than one row in ``KEYS``
    are broadcast instead, so they are ``KEYS`` at most, and their rows stay where they are. Both joins return
    each of their rows once. With ``tables``, the keys and the rows marked by the first join are stored between.
    """
    keys = [c for c in wanted.columns if c != "times"]
    most = max(FREQUENT, total // KEYS)
    wanted = (tables.store(wanted, "wanted") if tables else wanted).withColumn("all", F.lit(True))
    many, few = (wanted.where(x).drop("times") for x in (F.col("times") > most, F.col("times") <= most))
    if many.isEmpty():
        return rows.join(few, keys, "left")
    marked = rows.join(F.broadcast(many), keys, "left")
    marked = tables.store(marked, "marked") if tables else marked
    others = marked.where("all is null").drop("all").join(few, keys, "left")
    return marked.where("all").unionByName(others)


SHAPE = ["u1", "u2", "from_lo", "to_hi"]


def _judged(rows: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """Rows with ``all``: true if the stretch of all their windows occurs again around an anchor alike."""
    rows = rows.withColumns({"from_lo": F.col("s") - F.col("lo"), "to_hi": F.col("hi") - F.col("s")})
    return _marked(rows, _twice(rows, SHAPE), rows.count(), tables)


def _repeated(rows: DataFrame, keys: list[str], tables: Scratch | None = None) -> DataFrame:
    """The rows whose keys another row has, too."""
    return _marked(rows, _twice(rows, keys), rows.count(), tables).where("all").drop("all")


def _to_look_at(judged: DataFrame, group: list[str], tables: Scratch | None = None) -> DataFrame:
    """Places whose windows have to be looked at one level down.

    Those still open, and of those settled, one for each stretch, where its group has
    open ones that may repeat a part of it.
    """
    open_ = judged.where("all is null")
    groups = judged.groupBy(*group).agg(F.count("*").alias("times"), F.bool_or(F.col("all").isNull()).alias("open"))
    settled = judged.where("all").dropDuplicates(SHAPE).drop("all")
    settled = _marked(settled, groups.where("open").drop("open"), judged.count(), tables).where("all")
    columns = ["doc", "lo", "hi", "s"]
    return open_.select(*columns).union(settled.select(*columns))


def repeated_windows(docs: DataFrame, tables: Scratch, length: int, anchor: int, cell: int, buckets: int) -> DataFrame:
    """(doc, lo, hi): the windows that start at lo..hi are repeated. ``docs`` has doc and text."""
    long = docs.where(F.octet_length("text") >= length)
    splitters = _sampled_splitters(long, length, anchor, buckets)
    sent = long.mapInPandas(_suffixes(length, anchor, splitters), f"{FOUND}, lead binary, known boolean, bucket long")
    found = tables.store(sent.groupBy("bucket").applyInPandas(_sort_bucket, FOUND), "found")
    wholes = tables.store(_judged(found, tables), "wholes")
    tables.drop("found", "wanted", "marked")

    cells = _with_places(docs, _to_look_at(wholes, ["gram"], tables), "inner").mapInArrow(
        _cells(length, cell), "doc long, lo long, hi long, s long, cell long, core long, u1 long, u2 long"
    )
    cells = tables.store(cells, "cells")
    likely = tables.store(_repeated(cells, ["cell", "core"], tables), "likely")
    tables.drop("cells", "wanted", "marked")
    parts = tables.store(_judged(likely, tables), "parts")
    tables.drop("likely", "wanted", "marked")

    single = _with_places(docs, _to_look_at(parts, ["cell", "core"], tables), "inner").mapInArrow(
        _windows(length), "doc long, lo long, u1 long, u2 long"
    )
    single = tables.store(single, "single")
    tables.drop("wanted", "marked")
    windows = _repeated(single, ["u1", "u2"], tables)
    ranges = [df.where("all").select("doc", "lo", "hi") for df in (wholes, parts)]
    return ranges[0].union(ranges[1]).union(windows.select("doc", "lo", F.col("lo").alias("hi")))


def _covered(length: int):
    def run(batches):
        for batch in batches:
            docs, starts, ends, sizes = [], [], [], []
            for doc, _, places in _bytes_of(batch):
                order = np.argsort(places["lo"], kind="stable")
                lo, reach = places["lo"][order], np.maximum.accumulate(places["hi"][order] + length)
                new = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
                docs.append(doc)
                sizes.append(len(new))
                starts.append(lo[new])
                ends.append(reach[np.r_[new[1:] - 1, len(lo) - 1]])
            if docs:
                spans = pa.StructArray.from_arrays([np.concatenate(starts), np.concatenate(ends)], ["start", "end"])
                lists = pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype(np.int32), spans)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), lists], ["doc", "repeated"])

    return run


def with_repeated(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 400,
    anchor: int = 64,
    cell: int = 20,
    bucket_bytes: int = 1 << 24,
) -> DataFrame:
    """All rows and columns of ``documents`` with ``repeated``, spans in UTF-8 bytes, ascending.

    A span is a maximal run of bytes covered by strings of ``length`` bytes that start at
    another place too, in any row. Rows alike in id and text are two places. Null and short
    texts have no spans. A column named ``repeated`` is replaced. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    ready(spark)
    key, made = fresh(documents, "doc"), fresh(documents, "spans")
    rows = documents.withColumn(key, F.xxhash64(F.col(id_column), whole_text(text_column)))
    with scratch(spark, "suffixes") as tables:
        docs = rows.select(F.col(key).alias("doc"), whole_text(text_column).alias("text"))
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(8, math.ceil(total / bucket_bytes))
        ranges = repeated_windows(docs, tables, length, anchor, cell, buckets)
        lists = ranges.distinct().groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("places"))
        spans = tables.store(lists.mapInArrow(_covered(length), f"doc long, repeated {SPANS}"), "result")
    joined = rows.join(spans.toDF(key, made), key, "left")
    none = F.expr(f"cast(array() as {SPANS})")
    stay = [F.col(f"`{c}`") for c in documents.columns if c != "repeated"]
    return joined.select(*stay, F.coalesce(made, none).alias("repeated"))


def _left_over(text: str, spans) -> bytes:
    whole, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for span in spans:
        out.append(whole[at : span["start"]])
        at = span["end"]
    return b"".join([*out, whole[at:]])


def _kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([_left_over(t, s) for t, s in zip(texts, spans)], dtype=object)


def _digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    kept = [_left_over(t, s) for t, s in zip(texts, spans)]
    removed = [sum(x["end"] - x["start"] for x in s) for s in spans]
    return pd.DataFrame({
        "n_bytes": [len(k) + r for k, r in zip(kept, removed)],
        "n_removed": removed,
        "n_spans": [len(s) for s in spans],
        "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
    })


def kept_bytes(text: Column, spans: Column) -> Column:
    """The bytes of each text outside its spans. A character may be cut at a span's edge."""
    return F.pandas_udf(_kept, "binary")(text, spans)


def digest(text: Column, spans: Column) -> Column:
    """n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay."""
    return F.pandas_udf(_digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")(text, spans)
