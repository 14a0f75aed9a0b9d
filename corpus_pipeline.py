"""From raw documents to packed sequences: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
and reads again as the next stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.llm import minmax_hash, secret_ledger, target_mixing, toxic_segments, two_fit_packing
from gridmarts.llm.common import new_folder, whole_text
from gridmarts.llm.queries import LANGUAGE_TARGETS, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.3


def columns_of_documents(docs: DataFrame) -> DataFrame:
    """Extra columns, whatever their names, stay behind."""
    return docs.select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model learns from labelled rows outside the held-out quarter."""
    docs = columns_of_documents(docs)
    model = toxic_segments.learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return columns_of_documents(toxic_segments.scored(docs, model).where(F.col("toxic_score") < TOXIC_FROM))


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest id, then the smallest hash.

    A null id comes after all others. Rows are told apart by id and text, so rows of different groups stay though
    they share an id. Texts without words are near duplicates of nothing; all of them stay.
    """
    docs = columns_of_documents(docs)
    found = minmax_hash.near_duplicates(docs, with_keys=True)
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key").alias("key"))
    # an aggregate instead of a row number: a large group is reduced in every task that meets it
    chosen = found.groupBy("component_key").agg(F.min(first)["key"].alias("_row"), F.max("n_shingles").alias("_n"))
    rows = docs.withColumn("_row", F.xxhash64("doc_id", whole_text())).join(chosen.drop("component_key").hint("merge"), "_row")
    # of rows alike in id and text one stays, unless they have no words
    own = F.when(F.col("_n") == 0, F.struct(*COLUMNS))
    kept = rows.groupBy("_row", "_n", own.alias("_own")).agg(F.min(F.struct(*COLUMNS)).alias("_doc"), F.count("*").alias("_times"))
    times = F.when(F.col("_n") == 0, F.col("_times")).otherwise(F.lit(1))
    return columns_of_documents(kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).select("_doc.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    docs = columns_of_documents(docs)
    found = secret_ledger.find_secrets(docs, new_folder(spark, "secret-ledger"), "doc_id")
    some = F.size("secret_spans") > 0
    clean = secret_ledger.redacted(whole_text(), F.col("secret_spans"))
    found = found.withColumn("text", F.when(some, clean).otherwise(F.col("text")))
    found = found.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return columns_of_documents(found)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages that fall short of their target are repeated as often as it takes; no document is dropped."""
    docs = columns_of_documents(docs)
    labelled = target_mixing.bounded_labels(docs)
    mixed = target_mixing.mixed(docs, labelled, LANGUAGE_TARGETS, lowest=1.0)
    copies = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("copies")))
    return columns_of_documents(mixed.withColumn("copy", F.explode(copies)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return two_fit_packing.packed(columns_of_documents(docs), vocabulary(), end_id=0, size=2048)


STAGES = [
    ("toxicity", toxicity),
    ("minhash", minhash),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# learned models, sampling hashes and packing have no SQL form: tests compare the operators with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
