"""Near duplicates among documents by min-max hashing of word shingles.

Of each of ``permutations`` random permutations both the smallest and the largest value over
a document's shingles are kept, so half as many hash evaluations give a signature of a given
length. Either value agrees between two documents with a probability equal to their Jaccard
similarity, and the two are negatively correlated, which lowers the variance of the estimate.
Bands of ``rows`` signature values are bucket keys. With 64 permutations and 4 rows, a pair
at similarity 0.75 misses all 32 bands with probability 5e-6.

1. Documents with the same shingle set become one node.
2. In every bucket each node is tried against the smallest one. That is linear in the size
   of the bucket, and it joins groups of near copies at once.
3. Buckets that still hold nodes of different components are compared in full, in blocks,
   but only across components and on byte sketches of the signatures. Only pairs whose
   agreement is within reach of the threshold go on (at 0.75 a pair falls short with a
   probability of 3e-6), in the first bucket that both share.
4. Every pair that goes on is confirmed on its full shingle sets. In a block that happens on the spot: nodes
   tied together count as one component from then on, and the task returns a forest of links.

So buckets of copies are never expanded into pairs, and no link between different texts is
given up for the size of a group.

Stored tables with a row for each node, bucket or pair are joined by sorting and merging. Spark would take them to be as
large as their compressed files, a node's bands to be a single row, and broadcast what does not fit into the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmarts.llm.common import Scratch, components, deal_blocks, ready, scratch, whole_text
from gridmarts.llm.shingles import WORDS, in_pieces, mix, shingle_sets

SEED = 7_151_623
PIECE = 500_000  # characters that are hashed at once, which bounds a worker's arrays
VALUES = "node long, n long, set_low long, set_high long, bands array<long>, sketch binary"


def least_agreement(values: int, similarity: float, sigmas: float = 4.5) -> int:
    """Signature values in which a pair at the threshold agrees, but for ``sigmas`` deviations."""
    return math.floor(values * similarity - sigmas * math.sqrt(values * similarity * (1 - similarity)))


def signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Minima, then maxima, of every permutation over each set (none of them empty)."""
    rng = np.random.default_rng([SEED, permutations])
    turn = rng.integers(0, 1 << 63, size=permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, size=permutations, dtype=np.uint64)
    every = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), 2 * permutations), dtype=np.uint64)
    for k in range(permutations):
        x = (every ^ flip[k]) * turn[k]
        out[:, k] = np.minimum.reduceat(x, at)
        out[:, permutations + k] = np.maximum.reduceat(x, at)
    return out


def _signed(permutations: int, rows: int, words: int):
    def run(batches):
        for frame in batches:
            texts, nodes = frame["text"].to_list(), frame["node"].to_numpy()
            for lo, hi in in_pieces(texts, PIECE):
                sets = shingle_sets(texts[lo:hi], words)
                full = [i for i, s in enumerate(sets) if len(s)]
                out = pd.DataFrame({"node": nodes[lo:hi], "n": [len(s) for s in sets]})
                out["set_low"] = [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                out["set_high"] = [int(mix(s ^ np.uint64(SEED)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                bands, sketch = [None] * len(sets), [None] * len(sets)
                if full:
                    values = signatures([sets[i] for i in full], permutations)
                    grouped = values.reshape(len(full), -1, rows)
                    odd = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
                    keys = mix((mix(grouped) * odd).sum(axis=2, dtype=np.uint64)).astype(np.int64)
                    bytes_ = (mix(values) >> np.uint64(56)).astype(np.uint8)
                    for k, i in enumerate(full):
                        bands[i], sketch[i] = keys[k], bytes_[k].tobytes()
                yield out.assign(bands=bands, sketch=sketch)

    return run


def _compressed(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for frame in batches:
        packed = [pack.compress(t.encode("utf-8", "surrogatepass")) for t in frame["text"]]
        yield pd.DataFrame({"node": frame["node"], "packed": packed})


def _agree(least: int):
    def run(batches):
        for frame in batches:
            a, b = (np.frombuffer(b"".join(frame[c]), dtype=np.uint8).reshape(len(frame), -1) for c in ("sa", "sb"))
            same = (a == b).sum(axis=1)
            yield frame.assign(same=same)[same >= least][["a", "b", "same"]]

    return run


class _Sets:
    """Shingle sets of the rows of a task, made when they are first needed; a bounded number of shingles is kept."""

    def __init__(self, packed: list[bytes], words: int, most: int = 4_000_000):
        self.packed, self.words, self.most = packed, words, most
        self.known: dict[int, np.ndarray] = {}
        self.held, self.unpack = 0, zstandard.ZstdDecompressor()

    def of(self, rows: list[int]) -> list[np.ndarray]:
        new = [r for r in dict.fromkeys(rows) if r not in self.known]
        if self.held > self.most:
            self.known, self.held = {r: self.known[r] for r in rows if r in self.known}, 0
        for at in range(0, len(new), 64):
            part = new[at : at + 64]
            texts = [self.unpack.decompress(self.packed[r]).decode("utf-8", "surrogatepass") for r in part]
            for lo, hi in in_pieces(texts, PIECE):
                for r, own in zip(part[lo:hi], shingle_sets(texts[lo:hi], self.words)):
                    self.known[r] = own
                    self.held += len(own)
        return [self.known[r] for r in rows]


def _shared(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of the other sets (none empty) has in common with one."""
    every = np.concatenate(others)
    where = np.searchsorted(own, every)
    where[where == len(own)] = 0
    at = np.cumsum([0, *(len(x) for x in others[:-1])])
    return np.add.reduceat((own[where] == every).astype(np.int64), at)


def _forest(least: int, percent: int, words: int, tile: int = 256):
    """Links that tie together what is similar enough within each bucket or pair of blocks.

    Sketches say which pairs of different components are probable, and those are confirmed at once on their full
    sets, in the first bucket that both have in common. What has been tied together on the way is one component from then
    on, so a task returns at most a link for each row, however alike the rows are.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["band", "key", "p", "q", "component", "node"], kind="stable")
        node, side, band = (frame[c].to_numpy() for c in ("node", "side", "band"))
        sketch = np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(len(frame), -1)
        bands = np.stack(frame["bands"].to_list())
        sets, part = _Sets(frame["packed"].to_list(), words), np.unique(frame["component"], return_inverse=True)[1]
        groups = frame[["band", "key", "p", "q"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])
        out: list[tuple[int, int]] = []

        def confirm(x: np.ndarray, y: np.ndarray) -> None:
            for lo, hi in _edges(x):
                row, others = int(x[lo]), y[lo:hi]
                others = others[part[others] != part[row]]
                for at in range(0, len(others), tile):
                    some = others[at : at + tile]
                    some = some[part[some] != part[row]]
                    if not len(some):
                        continue
                    own, *rest = sets.of([row, *some.tolist()])
                    both = _shared(own, rest)
                    size = np.array([len(r) for r in rest])
                    for other in some[100 * both >= percent * (len(own) + size - both)].tolist():
                        if part[other] != part[row]:
                            out.append((int(node[row]), int(node[other])))
                            part[part == part[other]] = part[row]

        for lo, hi in zip(starts, np.r_[starts[1:], len(frame)]):
            both = side[lo] == 2
            first = lo + np.flatnonzero(side[lo:hi] != 1)
            second = first if both else lo + np.flatnonzero(side[lo:hi] == 1)
            for i in range(0, len(first), tile):
                r = first[i : i + tile]
                for j in range(i if both else 0, len(second), tile):
                    c = second[j : j + tile]
                    apart = part[r][:, None] != part[c][None, :]
                    if not apart.any():
                        continue
                    same = np.zeros((len(r), len(c)), dtype=np.int16)
                    for k in range(sketch.shape[1]):
                        same += sketch[r, k][:, None] == sketch[c, k][None, :]
                    x, y = np.nonzero((same >= least) & apart)
                    if both and i == j:
                        x, y = x[x < y], y[x < y]
                    x, y, agreed = r[x], c[y], same[x, y]
                    new = ~(bands[x, : band[lo]] == bands[y, : band[lo]]).any(axis=1)
                    rank = np.lexsort((-agreed[new], x[new]))  # the most alike first
                    confirm(x[new][rank], y[new][rank])
        return pd.DataFrame(np.array(out, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])

    return run


def _edges(x: np.ndarray):
    """Where each stretch of equal entries begins and ends."""
    cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else []
    return zip(cuts[:-1], cuts[1:])


def _confirm(percent: int, words: int):
    """Of each hub and the nodes tried against it, the pairs that are similar enough."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["hub", "salt", "is_hub"], ascending=[True, True, False], kind="stable")
        unpack = zstandard.ZstdDecompressor()
        hubs, nodes, is_hub = (frame[c].to_numpy() for c in ("hub", "node", "is_hub"))
        packed, out, against = frame["packed"].to_list(), [], np.empty(0, dtype=np.uint64)
        for at in range(0, len(frame), 64):
            texts = [unpack.decompress(x).decode("utf-8", "surrogatepass") for x in packed[at : at + 64]]
            sets = (own for lo, hi in in_pieces(texts, PIECE) for own in shingle_sets(texts[lo:hi], words))
            for i, own in enumerate(sets, at):
                if is_hub[i]:
                    against = own
                    continue
                where = np.searchsorted(against, own)
                where[where == len(against)] = 0
                both = int((against[where] == own).sum()) if len(against) else 0
                if 100 * both >= percent * (len(own) + len(against) - both) and both:
                    out.append((nodes[i], hubs[i]))
        return pd.DataFrame(np.array(out, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, words: int, load: int = 256) -> DataFrame:
    """The pairs (a, b) that reach the threshold on full sets. A hub b with many is salted."""
    salts = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / load).cast("int").alias("salts"))
    tried = pairs.withColumnRenamed("b", "hub").join(salts.hint("merge"), "hub").select(
        F.col("a").alias("node"), "hub", F.pmod(F.xxhash64("a"), "salts").cast("int").alias("salt"), F.lit(False).alias("is_hub")
    )
    held = salts.select(
        F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("is_hub")
    )
    rows = tried.unionByName(held)
    tasks = max(1, math.ceil(pairs.count() / load))
    return (
        rows.join(texts.hint("merge"), "node")
        .groupBy(F.pmod(F.xxhash64("hub", "salt"), F.lit(tasks)).alias("deal"))
        .applyInPandas(_confirm(percent, words), "a long, b long")
    )


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 75,
    words: int = WORDS,
    permutations: int = 64,
    rows: int = 4,
    block: int = 1024,
    with_keys: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents link when their shared shingles are at least ``percent`` percent of their joint
    ones. A null text or one without words has no shingles, links with nothing and is kept. Rows that
    repeat an id are rows of their own. The component is the smallest id reachable; a null id
    is used only where a component has no other. Other columns are ignored. An empty table gives an empty result.
    ``with_keys`` adds ``row_key``, the hash of id and text, and ``component_key``, which tells components apart
    where ids clash.
    """
    spark = documents.sparkSession
    ready(spark)
    least = least_agreement(2 * permutations, percent / 100)
    with scratch(spark, "minmax") as tables:
        docs = documents.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
        docs = docs.withColumn("node", F.xxhash64("id", "text"))
        signed = docs.select("node", "text").mapInPandas(_signed(permutations, rows, words), VALUES)
        ids = docs.select("node", "id")
        signed = tables.store(signed, "signed")
        sets = signed.where("n > 0").groupBy("n", "set_low", "set_high").agg(
            F.min("node").alias("rep"), F.min_by(F.struct("bands", "sketch"), "node").alias("values")
        )
        sets = tables.store(sets.select("n", "set_low", "set_high", "rep", "values.*"), "sets")
        reps = sets.select(F.col("rep").alias("node"), "bands", "sketch")
        links = _links(docs, reps, tables, least, percent, words, block)
        parts = components(links, tables)
        # rows: row -> node -> set -> component -> smallest document id
        keys = ["n", "set_low", "set_high"]
        placed = signed.select("node", *keys).distinct().join(sets.select(*keys, "rep").hint("merge"), keys, "left").join(
            parts.withColumnRenamed("node", "rep").hint("merge"), "rep", "left"
        ).select("node", "n", F.coalesce("component", "rep", "node").alias("component"))
        per_row = tables.store(ids.join(placed.hint("merge"), "node"), "rows")
        smallest = per_row.groupBy("component").agg(F.min("id").alias("component_id"))
        empty = F.col("n") == 0
        out = per_row.join(smallest.hint("merge"), "component").select(
            F.col("id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            *([F.col("node").alias("row_key"), F.col("component").alias("component_key")] if with_keys else []),
        )
        return tables.store(out.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))), "result")


def _links(docs: DataFrame, reps: DataFrame, tables: Scratch, least: int, percent: int, words: int, block: int) -> DataFrame:
    met = reps.select("node", F.posexplode("bands").alias("band", "key"))
    heads = met.groupBy("band", "key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    placed = tables.store(met.join(heads.hint("merge"), ["band", "key"]), "placed")
    some = placed.select("node").distinct()
    texts = docs.select("node", "text").mapInPandas(_compressed, "node long, packed binary")
    texts = tables.store(texts.join(some, "node", "left_semi").dropDuplicates(["node"]), "texts")
    sketches = reps.select("node", "sketch")

    # against the smallest node of a bucket: the smallest and the most alike of a node's heads
    stars = placed.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    likely = (
        stars.join(sketches.toDF("a", "sa").hint("merge"), "a").join(sketches.toDF("b", "sb").hint("merge"), "b")
        .mapInPandas(_agree(least), "a long, b long, same long")
    )
    chosen = likely.groupBy("a").agg(F.min("b").alias("low"), F.max_by("b", F.struct("same", "b")).alias("near"))
    tried = tables.store(
        chosen.select("a", F.explode(F.array_distinct(F.array("low", "near"))).alias("b")), "tried"
    )
    found = tables.store(_confirmed(tried, texts, percent, words), "found")
    parts = components(found, tables)

    # across components, what is left in each bucket
    where = placed.join(parts.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    where = tables.store(where, "where")
    open_ = where.groupBy("band", "key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo < hi").select("band", "key")
    dealt = deal_blocks(where.join(open_.hint("merge"), ["band", "key"]), ["band", "key"], "node", "n", block)
    dealt = tables.store(dealt.select("band", "key", "p", "q", "side", "node", "component"), "dealt")
    tasks = max(1, math.ceil(dealt.count() / (2 * block)))
    forest = (
        dealt.join(reps.hint("merge"), "node").join(texts.hint("merge"), "node")
        .groupBy(F.pmod(F.xxhash64("band", "key", "p", "q"), F.lit(tasks)).alias("deal"))
        .applyInPandas(_forest(least, percent, words), "a long, b long")
    )
    return found.union(tables.store(forest, "forest"))
