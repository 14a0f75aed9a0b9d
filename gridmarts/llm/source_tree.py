"""How far the sources of a language differ in the words they use.

Each language keeps the terms that enough of its documents have. A group (language, source) gives a kept term with
``count`` occurrences the weight p = 1 + floor(scale * (count + 2) / (N + 2 V)), and two weights differ by
f = floor((p - q)^2 / (p + q)). The sum of f over all V terms is wanted for every two sources of a language, most
of whose counts are zero. With f0, the value of two zero counts, it is

    V f0  +  (f(p, q0) - f0 over the terms that only count in the one)  +  the same for the other
          +  a correction f(p, q) - f(p, q0) - f(p0, q) + f0 for each term that counts in both.

The corrections come from a frequent-pattern tree. A row of the term table is the list of its nonzero
counts, ordered by source; rows are inserted as paths from the root, and each node has the number of
rows that go through it. A node and an ancestor of it are a pair of sources with the counts of that many terms, so each
such combination is computed once, however many terms share it. Nodes directly give the terms that count in one.

Rows are dealt by ranges of their paths, so that rows with a common beginning come to the same task and no source or language
is a task of its own; sums over any cut of the rows add up. A task holds a tree of at most ``most_nodes`` nodes, then writes its sums
and begins anew. Weights and values are whole numbers below 2^63, so all sums are exact.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmarts.llm.common import ready, scratch, whole_text

# Letters A-Z and a-z and all bytes beyond ASCII make terms; A-Z are lower-cased.
_KEEP = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


_DOCUMENT = 1 << 40  # a document adds this and its occurrences to the entry of a term


def _counted(most_entries: int, piece: int = 500_000):
    """Per task: occurrences and documents of each term by group, and a row without a term for each group."""

    def run(batches):
        found: dict[tuple[str, str], dict[bytes, int]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                group = found.setdefault((lang, source), {})
                before = len(group)
                for term, n in Counter(terms_of(text)).items():
                    group[term] = group.get(term, 0) + n + _DOCUMENT
                entries += len(group) - before
                if entries > most_entries:
                    yield from _flushed(found, piece)
                    found, entries = {}, 0
        yield from _flushed(found, piece)

    return run


def _flushed(found: dict, rows: int):
    for (lang, source), group in found.items():
        terms, sums = [None, *group], np.array([0, *group.values()], dtype=np.int64)
        for at in range(0, len(terms), rows):
            part = pa.array(terms[at : at + rows], pa.binary()).cast(pa.string())
            n, docs = sums[at : at + rows] % _DOCUMENT, sums[at : at + rows] // _DOCUMENT
            names = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(part), dtype=np.int64))) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*names, part, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def weight(count: Column, total: Column, terms: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 2) / (total + 2 * terms)), in decimals, as the product may not fit 64 bits."""
    wide = [F.lit(scale).cast("decimal(10,0)"), (count + 2).cast("decimal(19,0)"), (total + 2 * terms).cast("decimal(19,0)")]
    whole = F.call_function("div", wide[0] * wide[1], wide[2])
    return (1 + whole).cast("long")


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """Term rows of one language as paths from a root; items are (source, weight, weight of a zero count)."""

    def __init__(self):
        self.root: dict = {}
        self.parent: list[int] = []
        self.item: list[tuple[str, int, int]] = []
        self.rows: list[int] = []

    def insert(self, path, rows: int) -> None:
        children, node = self.root, -1
        for item in path:
            entry = children.get(item)
            if entry is None:
                entry = children[item] = (len(self.item), {})
                self.parent.append(node)
                self.item.append(item)
                self.rows.append(0)
            node, children = entry
            self.rows[node] += rows

    def corrections(self) -> list[tuple[str, str, int]]:
        """(source, later source, sum of corrections), from every node and each of its ancestors."""
        if not self.item:
            return []
        names = sorted({i[0] for i in self.item})
        number = {n: k for k, n in enumerate(names)}
        source = np.array([number[i[0]] for i in self.item], dtype=np.int64)
        p, zero = (np.array([i[k] for i in self.item], dtype=np.int64) for k in (1, 2))
        rows, parent = np.array(self.rows, dtype=np.int64), np.array(self.parent, dtype=np.int64)
        sums: dict[int, int] = {}
        node, above = np.arange(len(p)), parent
        while True:
            node, above = node[above >= 0], above[above >= 0]
            if not len(node):
                break
            a, b = above, node
            value = _difference(p[a], p[b]) - _difference(p[a], zero[b]) - _difference(zero[a], p[b])
            value = (value + _difference(zero[a], zero[b])) * rows[b]
            pair, back = np.unique(source[a] * len(names) + source[b], return_inverse=True)
            total = np.zeros(len(pair), dtype=np.int64)
            np.add.at(total, back, value)
            for k, v in zip(pair.tolist(), total.tolist()):
                sums[k] = sums.get(k, 0) + v
            above = parent[above]
        return [(names[k // len(names)], names[k % len(names)], v) for k, v in sums.items()]


def _trees(most_nodes: int):
    def run(batches):
        trees: dict[str, Tree] = {}
        for frame in batches:
            for lang, path, rows in zip(frame["lang"], frame["path"], frame["rows"]):
                tree = trees.setdefault(lang, Tree())
                tree.insert([(i["source"], i["p"], i["zero"]) for i in path], rows)
                if sum(len(t.item) for t in trees.values()) > most_nodes:
                    yield _sums(trees)
                    trees = {}
        yield _sums(trees)

    return run


def _sums(trees: dict[str, Tree]) -> pd.DataFrame:
    rows = [(lang, *r) for lang, tree in trees.items() for r in tree.corrections()]
    return pd.DataFrame(rows, columns=["lang", "a", "b", "value"]).astype({"value": "int64"})


def divergence(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_documents: int = 10,
    scale: int = 1_000_000_000,
    top: int = 10,
    most_entries: int = 800_000,
    most_nodes: int = 300_000,
    cuts: int = 16,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring group.

    Part ``pair``: the other sources of the language by how much they differ. Part ``term``: up to ``top`` terms that the group uses
    more than its language does, by how much. Values descend, then items ascend by their bytes. Null texts,
    languages and sources count as ''. A group without terms has pairs; without other sources it has none. Rows that repeat
    count as often as they come. Other columns are ignored. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    ready(spark)
    docs = documents.select(
        whole_text(lang_column).alias("lang"), whole_text(source_column).alias("source"), whole_text(text_column).alias("text")
    )
    with scratch(spark, "source-tree") as tables:
        part = docs.mapInArrow(_counted(most_entries), "lang string, source string, term string, n long, docs long")
        every = part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        every = tables.store(every, "every")
        words = every.where("term is not null")
        kept = words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(
            F.col("docs") >= least_documents
        )
        kept = tables.store(kept.drop("docs"), "kept")
        langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
        counts = tables.store(words.drop("docs").join(kept, ["lang", "term"]), "counts")
        totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = every.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
        groups = groups.join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
        zero = F.when(F.col("terms") > 0, weight(F.lit(0), F.col("total"), F.col("terms"), scale)).otherwise(0)
        groups = tables.store(groups.withColumn("zero", zero), "groups")
        weighed = counts.join(groups, ["lang", "source"]).withColumn(
            "p", weight(F.col("n"), F.col("total"), F.col("terms"), scale)
        )
        weighed = tables.store(weighed, "weighed")

        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        average = weight(F.col("lang_n"), F.col("lang_total"), F.col("terms"), scale)
        terms = weighed.withColumn("q", average).where("p > q").select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")
        )
        terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

        both = _pairs_in_both(weighed, most_nodes)
        alone = _only_in_one(weighed, groups, cuts)
        a, b = (groups.select("lang", F.col("source").alias(x), F.col("zero").alias(f"{x}0"), *([F.col("terms")] if x == "a" else [])) for x in "ab")
        none = a.join(b, "lang").where("a <> b").select(
            "lang", "a", "b", F.when(F.col("terms") > 0, F.col("terms") * difference(F.col("a0"), F.col("b0"))).otherwise(0).alias("value")
        )
        parts = none.unionByName(both).unionByName(alone)
        pairs = parts.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value")).select(
            "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value"
        )
        pairs = pairs.withColumn("rank", F.row_number().over(order))
        return tables.store(pairs.unionByName(terms), "result")


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))


def _pairs_in_both(weighed: DataFrame, most_nodes: int) -> DataFrame:
    """(lang, a, b, value): sums of the corrections, from trees of the term rows."""
    path = F.array_sort(F.collect_list(F.struct("source", "p", "zero")))  # a term has one row per source
    rows = weighed.groupBy("lang", "term").agg(path.alias("path")).where(F.size("path") > 1)
    rows = rows.groupBy("lang", "path").agg(F.count("*").alias("rows"))
    found = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    sums = found.mapInPandas(_trees(most_nodes), "lang string, a string, b string, value long")
    return _both_ways(sums.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value")))


def _only_in_one(weighed: DataFrame, groups: DataFrame, cuts: int) -> DataFrame:
    """(lang, a, b, value): what the terms of each source add against a source without them, both ways.

    Equal weights of a source are one row. They meet the other sources of their language in ``cuts`` parts, so that no
    language is one task.
    """
    nodes = weighed.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("rows"))
    nodes = nodes.withColumn("cut", F.pmod(F.xxhash64("source", "p"), F.lit(cuts)).cast("int"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("zero").alias("b0"))
    others = others.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))
    value = F.col("rows") * (difference(F.col("p"), F.col("b0")) - difference(F.col("zero"), F.col("b0")))
    met = nodes.join(others, ["lang", "cut"]).where("source <> b")
    found = met.groupBy("lang", F.col("source").alias("a"), "b").agg(F.sum(value).cast("long").alias("value"))
    return _both_ways(found)
