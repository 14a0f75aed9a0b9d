"""Backfill CSV files to the schema of the price feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.schemas import BACKFILL_SOURCE, HUB_TYPE, ZONE_TYPE
from gridmarts.sources.feeds import union_feeds

# Texts that a CSV reader on the data-frame side takes for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

TIME = "datetime_beginning_ept"

# Which header means which feed column. A rule is (target, any of these
# words, all of these words, exactly one of these headers); the first rule that fits wins.
_SHARED_RULES = [
    ("congestion_price{}", ["congestion"], [], []),
    ("marginal_loss_price{}", ["loss", "marginal"], [], []),
    ("pnode_name", ["zone", "respondent_name", "pnode_name"], [], []),
    ("pnode_id", [], [], ["respondent", "pnode_id"]),
]
DA_RULES = [
    (TIME, ["datetime", "period"], [], ["date", "hour"]),
    ("total_lmp{}", [], ["lmp", "da"], []),
    ("system_energy_price{}", ["da", "price"], ["energy"], []),
    *_SHARED_RULES,
]
RT_RULES = [
    (TIME, ["datetime", "period"], [], []),
    ("total_lmp{}", [], ["lmp", "rt"], []),
    ("system_energy_price{}", [], ["energy"], []),
    *_SHARED_RULES,
]


def files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files under ``path``, those with the same header line together."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("at"),
        "value",
    )
    # Within a block the ids ascend, and the first block has the header.
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    layouts = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [row["files"] for row in layouts.orderBy("header").collect()]  # names of files only


def normalise_files(
    spark: SparkSession, path: str, normalise: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """CSV files of any mix of layouts: each header is read and normalised on its own.

    Everything is text in the result, so that layouts agree; ``conform`` gives it types.
    """
    parts = [normalise(read_csv(spark, files)) for files in files_by_header(spark, path)]
    return union_feeds(*[part.select(*[F.col(c).cast("string") for c in part.columns]) for part in parts])


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with the same header line, every column as text, missing values as NULL.

    Spark applies one header to all files by position; a file with another one stops the
    job. :func:`normalise_files` takes files of different headers.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    return raw.select(
        *[F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )


def canonical_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def target_of(header: str, rules: list, suffix: str) -> str | None:
    """The feed column that a header stands for, or None."""
    for target, any_of, all_of, exact in rules:
        worded = bool(any_of or all_of)
        fits = (not any_of or any(w in header for w in any_of)) and all(w in header for w in all_of)
        if (worded and fits) or header in exact:
            return target.format(suffix)
    return None


def _hour_text(hour: Column) -> Column:
    return F.when(F.instr(hour, ":") > 0, hour).otherwise(F.concat(hour, F.lit(":00")))


def _combined(headers: list[str]) -> Column:
    """One value out of the columns that mean the same thing."""
    parts = [F.col(h) for h in headers]
    if "date" in headers and "hour" in headers:
        both = F.concat_ws(" ", F.trim("date"), _hour_text(F.trim("hour")))
        whole = F.when(F.col("date").isNotNull() & F.col("hour").isNotNull(), both)
        parts = [F.col(h) for h in headers if h not in ("date", "hour")] + [whole]
    return F.coalesce(*parts)


def _flat_layout(df: DataFrame, rules: list, suffix: str) -> DataFrame:
    meant: dict[str, list[str]] = {}
    for header in df.columns:
        target = target_of(header, rules, suffix) or header
        meant.setdefault(target, []).append(header)
    out = df.select(*[_combined(headers).alias(target) for target, headers in meant.items()])
    nothing = F.lit(None).cast("string")
    for required in (TIME, "pnode_name", f"total_lmp{suffix}"):
        if required not in out.columns:
            out = out.withColumn(required, nothing)
    defaults = {"pnode_type": F.lit(ZONE_TYPE), "zone": F.col("pnode_name"), "type": F.lit(ZONE_TYPE)}
    missing = {name: value for name, value in defaults.items() if name not in out.columns}
    return out.withColumns({**missing, "source": F.lit(BACKFILL_SOURCE)})


def _api_layout(df: DataFrame, suffix: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    ident = F.col("respondent") if "respondent" in df.columns else nothing
    name = F.col("respondent_name") if "respondent_name" in df.columns else ident
    return df.select(
        F.col("period").alias(TIME),
        name.alias("pnode_name"),
        ident.alias("pnode_id"),
        F.lit(ZONE_TYPE).alias("pnode_type"),
        name.alias("zone"),
        F.lit(ZONE_TYPE).alias("type"),
        F.col("value").try_cast("double").alias(f"total_lmp{suffix}"),
        F.lit(BACKFILL_SOURCE).alias("source"),
    )


def normalise_da_zones(raw: DataFrame) -> DataFrame:
    """Day-ahead prices: feed layout as it is, API layout, or headers matched by rule."""
    df = canonical_headers(raw)
    if {TIME, "total_lmp_da"} <= set(df.columns):
        return df
    if {"period", "value"} <= set(df.columns):
        return _api_layout(df, "_da")
    return _flat_layout(df, DA_RULES, "_da")


def normalise_da_hubs(raw: DataFrame) -> DataFrame:
    hub = F.lit(HUB_TYPE)
    return normalise_da_zones(raw).withColumns({"pnode_type": hub, "type": hub})


def normalise_rt_zones(raw: DataFrame) -> DataFrame:
    """Real-time prices: feed layout, or headers matched by rule."""
    df = canonical_headers(raw)
    if {TIME, "total_lmp_rt"} <= set(df.columns):
        return df.withColumn("source", F.lit(BACKFILL_SOURCE))
    return _flat_layout(df, RT_RULES, "_rt")
