"""Saved pages of an HTTP feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.schemas import FEEDS
from gridmarts.sources.feeds import conform


def _elements(page: Column) -> Column:
    """The list that a page holds: the page itself, or its ``items``, else its ``data``."""
    listed = F.try_variant_get(page, "$[0]", "variant").isNotNull()
    inner = [F.try_variant_get(page, f"$.{name}", "array<variant>") for name in ("items", "data")]
    return F.when(listed, F.try_variant_get(page, "$", "array<variant>")).otherwise(F.coalesce(*inner))


def unwrap_pages(
    spark: SparkSession,
    path: str,
    feed: str,
    whole_file: bool = True,
    element: str | None = None,
    rejected: str | None = None,
) -> DataFrame:
    """Rows of saved pages, each a bare list or an object with ``items`` or ``data``.

    ``items`` wins over ``data``. An object with neither holds no rows. Every element of a list is a row, also
    one that has none of the feed's fields. With ``whole_file`` a file is one page; without it, every line is
    one; blank ones are no pages. ``element`` names a column for the whole element, with the fields that the feed does not know.
    A page that is not whole JSON stops the job: its rows would be missing without a trace. With
    ``rejected`` such pages are written to that folder instead, with the files they come from.
    """
    text = spark.read.text(path, wholetext=whole_file)
    text = text.select("value", F.col("_metadata.file_path").alias("file"))
    text = text.filter(F.btrim("value", F.lit(" \t\r\n")) != "")
    parse = F.parse_json if rejected is None else F.try_parse_json
    if rejected is not None:
        bad = text.filter(F.try_parse_json("value").isNull())
        bad.select("file", F.col("value").alias("page")).write.mode("overwrite").parquet(rejected)
    rows = text.select(F.explode(_elements(parse("value"))).alias("row"))
    # everything is taken as text: pages disagree on whether an id or a price is quoted
    fields = [F.try_variant_get("row", f"$.{f.name}", "string").alias(f.name) for f in FEEDS[feed]]
    if element is None:
        return conform(rows.select(*fields), FEEDS[feed])
    return conform(rows.select(*fields, F.col("row").alias(element)), FEEDS[feed], keep=(element,))
