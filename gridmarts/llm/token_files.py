"""Token ids as flat unsigned integer files with 64-bit document offsets.

A shard is three files: ``.ids`` with the ids of its documents one after the other (16 bits
each where the vocabulary allows, else 32), ``.offsets`` with one 64-bit offset more than
documents, counted in ids from the start of the shard, and ``.docs`` with the 64-bit document
ids. Shards follow each other in ascending document id. The manifest, a Parquet table with one
row per shard, adds the number of ids before each shard, a prefix sum of the shards' totals.
Files are memory-mapped where the folder is a local or mounted one and read in
ranges otherwise.

A task writes under a name of its own and moves the finished files into place, so tasks that
run again or twice leave whole files.
"""

from __future__ import annotations

import uuid
import zlib
from urllib.parse import urlparse

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.llm.common import new_folder, ready, whole_text
from gridmarts.llm.pretokens import word_cache
from gridmarts.llm.shingles import in_pieces

NULL_ID = np.iinfo(np.int64).min  # stands for a null document id
MANIFEST = "shard long, docs long, tokens long, bits int"


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named by a path or URI, and the path on it."""
    if urlparse(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(folder)


def _write_shard(folder: str, vocabulary: str, end_id: int | None):
    def run(batches):
        store, path = place(folder)
        cache = word_cache(vocabulary)
        bits = 16 if cache.tokenizer.get_vocab_size() <= 1 << 16 else 32
        shard = TaskContext.get().partitionId()
        own = f"{path}/writing-{shard}-{uuid.uuid4().hex}"
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        docs = total = 0
        with store.open_output_stream(f"{own}.ids") as ids_out, store.open_output_stream(
            f"{own}.offsets"
        ) as at_out, store.open_output_stream(f"{own}.docs") as docs_out:
            at_out.write(np.zeros(1, dtype="<u8").tobytes())
            for frame in batches:
                texts = frame["text"].to_list()
                for lo, hi in in_pieces(texts):
                    for ids in cache.encode(texts[lo:hi]):
                        ids = np.concatenate([ids, end])
                        total += len(ids)
                        ids_out.write(ids.astype(f"<u{bits // 8}").tobytes())
                        at_out.write(np.array([total], dtype="<u8").tobytes())
                docs_out.write(frame["id"].fillna(NULL_ID).astype("int64").to_numpy().astype("<i8").tobytes())
                docs += len(frame)
        for kind in ("ids", "offsets", "docs"):
            store.move(f"{own}.{kind}", f"{path}/shard-{shard:06d}.{kind}")
        yield pd.DataFrame({"shard": [shard], "docs": [docs], "tokens": [total], "bits": [bits]})

    return run


def write_files(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the shards and return the manifest: shard, docs, tokens, bits, start.

    Null texts are empty: such a document has the end id alone, if there is one. Null ids come
    first. Rows that repeat an id are documents of their own, side by side. Other columns are ignored. An empty
    table gives an empty manifest or empty shards.
    """
    spark = documents.sparkSession
    ready(spark)
    store, path = place(folder)
    store.create_dir(path, recursive=True)
    rows = documents.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    # the hash lets one id with very many rows be dealt to several shards
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    made = ordered.select(F.col("id"), "text").mapInPandas(_write_shard(folder, vocabulary, end_id), MANIFEST)
    shards = made.toPandas().sort_values("shard")  # one row per shard
    shards["start"] = shards["tokens"].cumsum() - shards["tokens"]
    manifest = spark.createDataFrame(shards, f"{MANIFEST}, start long")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, start long").parquet(f"{folder}/manifest")


class Numbers:
    """The numbers of a file by slices: memory-mapped on local file systems, else only the slice is read."""

    def __init__(self, store: fs.FileSystem, path: str, kind: str):
        self.kind, self.mapped = np.dtype(kind), None
        self.size = store.get_file_info(path).size // self.kind.itemsize
        if isinstance(store, fs.LocalFileSystem):
            self.mapped = np.memmap(path, dtype=kind, mode="r") if self.size else np.zeros(0, dtype=kind)
        else:
            self.file = store.open_input_file(path)

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[part]
        lo, hi, _ = part.indices(self.size)
        wide = self.kind.itemsize
        return np.frombuffer(self.file.read_at(max(0, hi - lo) * wide, lo * wide), dtype=self.kind)

    def __enter__(self) -> Numbers:
        return self

    def __exit__(self, *_) -> None:
        if self.mapped is None:
            self.file.close()


def _sums(ids: Numbers, cuts: np.ndarray, most: int) -> list[int]:
    """CRC-32 of each document's ids as 32-bit numbers; at most ``most`` ids, or one document, are read at once."""
    out, i = [], 0
    while i < len(cuts) - 1:
        j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + most, side="right")) - 1)
        j = min(j, len(cuts) - 1)
        part, own = ids[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i]
        out += [zlib.crc32(part[a:b].astype("<u4").tobytes()) for a, b in zip(own[:-1], own[1:])]
        i = j
    return out


def _read_shards(folder: str, rows: int = 10_000, most: int = 1 << 22):
    def run(batches):
        store, path = place(folder)
        for frame in batches:
            for shard, bits, base in zip(frame["shard"], frame["bits"], frame["start"]):
                name = f"{path}/shard-{shard:06d}"
                with Numbers(store, f"{name}.ids", f"<u{bits // 8}") as ids, Numbers(
                    store, f"{name}.offsets", "<u8"
                ) as at, Numbers(store, f"{name}.docs", "<i8") as docs:
                    for lo in range(0, len(docs), rows):
                        part = docs[lo : lo + rows]
                        cuts = at[lo : lo + len(part) + 1].astype(np.int64)
                        yield pd.DataFrame({
                            "id": pd.array(part, dtype="Int64").astype("Int64") if not (part == NULL_ID).any()
                            else pd.Series([None if d == NULL_ID else int(d) for d in part], dtype="Int64"),
                            "start": base + cuts[:-1],
                            "n_tokens": np.diff(cuts),
                            "ids_crc32": np.array(_sums(ids, cuts, most), dtype=np.int64),
                        })

    return run


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32."""
    ready(spark)
    shards = read_manifest(spark, folder).where("docs > 0")
    return shards.repartition("shard").mapInPandas(
        _read_shards(folder), "id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(documents: DataFrame, vocabulary: str, end_id: int | None, folder: str | None = None) -> DataFrame:
    """Write files for the documents and describe each document as the files hold it."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "token-files")
    write_files(documents, folder, vocabulary, end_id)
    return read_files(spark, folder).withColumnRenamed("id", "doc_id")
