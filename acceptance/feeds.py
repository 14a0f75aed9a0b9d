"""Market feeds derived from ``lineitem``, ``orders`` and ``events``.

A line item's ship date plus its order number modulo 24 is the hour, its supplier
number modulo 5 the pricing node. Hours before 1998 arrive in ISO text as backfill
rows, later ones in US-style text as rows of the API.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmarts.functions.means import exact_mean
from gridmarts.schemas import FEEDS
from gridmarts.session import shared_folder
from gridmarts.sources.feeds import scan_feed

# Fixed values: (id text, name, type, zone) of node 0 to 4.
NODES = [
    ("51217", "WESTERN HUB", "HUB", None),
    ("50001", "DUQ", "ZONE", "DUQ"),
    ("50002", "AEP", "ZONE", "AEP"),
    ("50003", " PECO ", "ZONE", " PECO "),
    ("N/A", "NODE_4", "LOAD", "NODE"),
]
FIRST_API_YEAR = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _node(field: int) -> Column:
    """A node property by node number ``k``."""
    values = F.array(*[F.lit(node[field]).cast("string") for node in NODES])
    return values[F.col("k").cast("int")]


def _api() -> Column:
    return F.year("h") >= FIRST_API_YEAR


def _text(ts: Column, us_style: Column) -> Column:
    """The time as text, put together so that the session time zone has no part in it."""
    day = F.concat_ws("/", F.month(ts), F.dayofmonth(ts), F.year(ts))
    clock = F.concat_ws(":", F.hour(ts), F.lpad(F.minute(ts).cast("string"), 2, "0"))
    return F.when(us_style, F.concat_ws(" ", day, clock)).otherwise(ts.cast("string"))


def _hourly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.expr("l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 as int))")
    return table(spark, sf_dir, "lineitem").withColumns({"h": hour, "k": F.col("l_suppkey") % 5})


def da_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _hourly_lines(spark, sf_dir).groupBy("h", "k").agg(
        F.min("l_quantity").alias("system_energy_price_da"),
        F.max("l_discount").alias("congestion_price_da"),
        F.max("l_tax").alias("marginal_loss_price_da"),
        (F.min("l_extendedprice") / 1000).alias("total_lmp_da"),
    )
    return prices.select(
        _text(F.col("h"), _api()).alias("datetime_beginning_ept"),
        _node(0).alias("pnode_id"),
        _node(1).alias("pnode_name"),
        F.when(_api(), _node(2)).alias("type"),
        F.when(~_api(), _node(2)).alias("pnode_type"),
        _node(3).alias("zone"),
        F.when(~_api(), "eia").alias("source"),
        "system_energy_price_da",
        "congestion_price_da",
        "marginal_loss_price_da",
        "total_lmp_da",
    )


def rt_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Part of the rule of this feed: some hours have a day-ahead price only.
    lines = _hourly_lines(spark, sf_dir).filter("l_quantity > 20")
    prices = lines.groupBy("h", "k").agg(
        F.min("l_quantity").alias("system_energy_price_rt"),
        F.max("l_discount").alias("congestion_price_rt"),
        F.max("l_tax").alias("marginal_loss_price_rt"),
        (F.max("l_extendedprice") / 1000).alias("total_lmp_rt"),
    )
    return prices.select(
        _text(F.col("h"), _api()).alias("datetime_beginning_ept"),
        _node(0).alias("pnode_id"),
        _node(1).alias("pnode_name"),
        _node(2).alias("type"),
        _node(3).alias("zone"),
        "system_energy_price_rt",
        "congestion_price_rt",
        "marginal_loss_price_rt",
        "total_lmp_rt",
    )


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _hourly_lines(spark, sf_dir).groupBy("h", "k").agg(F.sum("l_quantity").alias("mw"))
    return loads.select(
        _text(F.col("h"), _api()).alias("datetime_beginning_ept"),
        F.concat(F.lit(" "), F.lower(_node(1)), F.lit(" ")).alias("zone"),
        _node(1).alias("load_area"),
        F.lit(" RFC ").alias("nerc_region"),
        F.when(F.col("k") % 2 == 0, "true").otherwise("0").alias("is_verified"),
        "mw",
    )


def forecast_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    lines = _hourly_lines(spark, sf_dir).select("l_orderkey", "h", "k", "l_quantity")
    rows = lines.join(orders, "l_orderkey").select("o_orderdate", "h", "k", "l_quantity")
    # a row for every line: dealt before it has its texts, which are several times as wide
    return rows.hint("rebalance", F.col("h"), F.col("o_orderdate")).select(
        _text(F.col("o_orderdate"), _api()).alias("evaluated_at_datetime_ept"),
        _text(F.col("h"), _api()).alias("forecast_datetime_beginning_ept"),
        _node(1).alias("forecast_area"),
        (F.col("l_quantity") * 2).alias("forecast_load_mw"),
    )


def rt_5min_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.expr("ts - make_dt_interval(0, 0, minute(ts) % 5, extract(second from ts))")
    events = table(spark, sf_dir, "events").select(
        slot.alias("h"), (F.col("user_id") % 5).alias("k"), "value"
    )
    return _event_prices(events, "rt", exact_mean(2)(F.col("value")))


def da_recent_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly day-ahead prices for the days of the five-minute feed."""
    hour = F.expr("ts - make_dt_interval(0, 0, minute(ts), extract(second from ts))")
    events = table(spark, sf_dir, "events").select(
        hour.alias("h"), (F.col("user_id") % 5).alias("k"), "value"
    )
    return _event_prices(events, "da", F.max("value"))


def _event_prices(events: DataFrame, suffix: str, total: Column) -> DataFrame:
    prices = events.groupBy("h", "k").agg(
        F.min("value").alias(f"congestion_price_{suffix}"),
        F.max("value").alias(f"marginal_loss_price_{suffix}"),
        total.alias(f"total_lmp_{suffix}"),
    )
    return prices.select(
        _text(F.col("h"), F.lit(True)).alias("datetime_beginning_ept"),
        _node(0).alias("pnode_id"),
        _node(1).alias("pnode_name"),
        _node(2).alias("type"),
        _node(3).alias("zone"),
        f"congestion_price_{suffix}",
        f"marginal_loss_price_{suffix}",
        f"total_lmp_{suffix}",
    )


DERIVED = {
    "da_lmps": da_feed,
    "rt_lmps": rt_feed,
    "load": load_feed,
    "load_forecast": forecast_feed,
    "rt_5min": rt_5min_feed,
    "da_recent": da_recent_feed,
}
_TIME_AND_NODE = ("datetime_beginning_ept", "pnode_id")
_SPREAD = {name: _TIME_AND_NODE for name in DERIVED} | {
    "load": ("datetime_beginning_ept", "zone"),
    "load_forecast": (),  # dealt in its own rule
}
_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed as it would arrive: Parquet files, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = f"{shared_folder(spark)}/landed-{name}-{uuid.uuid4().hex}"
        rows, columns = DERIVED[name](spark, sf_dir), [F.col(c) for c in _SPREAD[name]]
        (rows.hint("rebalance", *columns) if columns else rows).write.parquet(path)
        _landed[key] = path
    feed = name if name in FEEDS else "da_lmps"
    return scan_feed(spark, _landed[key], feed)
