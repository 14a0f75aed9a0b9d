"""The queries of this folder, each over its whole tables: (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.llm import (
    block_knn,
    merge_pieces,
    minmax_hash,
    periodic_runs,
    pii_crf,
    rotation_codes,
    secret_ledger,
    source_tree,
    suffix_dedup,
    target_mixing,
    token_files,
    toxic_segments,
    two_fit_packing,
)
from gridmarts.llm.common import new_folder, whole_text

VOCABULARY = "byte_bpe_50k.json"  # of the public tokenizers installed beside Python
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation_codes.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["rank"] < len(pii_crf.KINDS))

    def count(rank):
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return pii_crf.find_personal_data(docs).select(
        "doc_id",
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(pii_crf.KINDS)),
        F.sha2(pii_crf.as_text(base).cast("binary"), 256).alias("base_sha256"),
        pii_crf.as_text(spans).alias("spans"),
        F.size(spans).cast("long").alias("n_spans"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = suffix_dedup.with_repeated(docs)
    return found.select("doc_id", suffix_dedup.digest(whole_text(), F.col("repeated")).alias("d")).select("doc_id", "d.*")


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxic_segments.learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxic_segments.scored(docs.select("doc_id", "text"), model)
    return score.select(
        "doc_id",
        toxic_segments.held_out().alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = secret_ledger.find_secrets(docs, new_folder(spark, "secret-ledger"), "doc_id")
    spans = F.col("secret_spans")
    base = secret_ledger.of_kind(spans, *(r.kind for r in secret_ledger.BASE_RULES))
    return found.select(
        "doc_id",
        *(
            F.size(secret_ledger.of_kind(spans, r.kind)).cast("long").alias(f"n_{r.kind}")
            for r in secret_ledger.BASE_RULES
        ),
        F.sha2(secret_ledger.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_ledger.as_text(spans).alias("spans"),
    )


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_files.round_trip(docs, vocabulary(), end_id=2)


# shares of the expected tokens by language
LANGUAGE_TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def op7_target_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = target_mixing.bounded_labels(docs)
    mixed = target_mixing.mixed(docs.select("doc_id", "text"), labelled, LANGUAGE_TARGETS)
    shares = [F.element_at("posteriors", i + 1).alias(f"p_{d}") for i, d in enumerate(sorted(LANGUAGE_TARGETS))]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


def op8_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return two_fit_packing.packed(docs, vocabulary(), end_id=0, size=2048)


def op9_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return block_knn.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


def op10_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_hash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The texts, of which every tenth by the checksum of its id goes on periodically from a word of its own.

    A null id has no checksum; its text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumns({
        "g": F.floor(h / 10),
        "w": F.when(h % 10 == 0, F.filter(F.split(whole_text(), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")),
    })
    n = F.size("w")
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    left = n - F.col("a")
    docs = docs.withColumn("p", (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), again), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs.with_runs(with_planted_period(docs))
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", greatest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.call_function("div", 1000 * F.col("best.n"), -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_source_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_tree.divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         row_number() OVER () AS row
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, l.lang_total,
         (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.lang = g.lang AND c.source = g.source)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l USING (lang)
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op13_merge_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = F.array_join(F.col("piece_ids").cast("array<string>"), ",")
    return merge_pieces.encoded(docs, public_tokenizers.path(PIECES)).select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return {
        "pipeline": pipeline,
        "op1_rotation_codes": op1_rotation_codes,
        "op2_pii_crf": op2_pii_crf,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_toxic_segments": op4_toxic_segments,
        "op5_secret_ledger": op5_secret_ledger,
        "op6_token_files": op6_token_files,
        "op7_target_mixing": op7_target_mixing,
        "op8_two_fit_packing": op8_two_fit_packing,
        "op9_block_knn": op9_block_knn,
        "op10_minmax_hash": op10_minmax_hash,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_source_tree": op12_source_tree,
        "op13_merge_pieces": op13_merge_pieces,
    }


def all_oracles() -> dict[str, str]:
    return {"op12_source_tree": OP12_SQL}
