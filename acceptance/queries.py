"""One query per operator, each a function of (spark, directory of the test tables)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import feeds
from gridmarts import schemas
from gridmarts.functions.means import exact_mean
from gridmarts.functions.timeparse import naive, us_wall_clock, wall_clock
from gridmarts.operators.file_upsert import upsert_files
from gridmarts.operators.quality import check_not_null, check_unique, observed
from gridmarts.operators.upsert import (
    merge_frames,
    newer_than,
    read_table,
    upsert_table,
    write_history,
)
from gridmarts.plans import changes, dims, kpi, marts, rolling, series, staging, tiers
from gridmarts.session import shared_folder
from gridmarts.sources import catalog, normalise, pages, sinks
from gridmarts.sources.feeds import conform, feed_window, first_landed, scan_feed, union_feeds
from gridmarts.streaming.ingest import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}

HOUR = "hour_beginning_utc"
CUT = datetime(1999, 6, 30)  # stored history ends here in the incremental queries
OVERLAP_HOURS = 24 * 30  # and the batch starts this much earlier
HOURLY_RANGE = ("1998-03-01", "1998-08-31")
DAILY_RANGE = ("1995-01-01", "2001-12-31")
INTRADAY_RANGE = ("2024-01-24", "2024-01-30")


def query(fn: Query) -> Query:
    _REGISTERED[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _da(spark, sf_dir):
    return staging.stage_da(feeds.landed(spark, sf_dir, "da_lmps"))


def _rt(spark, sf_dir):
    return staging.stage_rt(feeds.landed(spark, sf_dir, "rt_lmps"))


def _build_lmps(spark, sf_dir):
    return marts.build_mart_lmps(_da(spark, sf_dir), _rt(spark, sf_dir))


def _build_load(spark, sf_dir):
    load = staging.stage_load(feeds.landed(spark, sf_dir, "load"))
    forecast = staging.stage_forecast(feeds.landed(spark, sf_dir, "load_forecast"))
    return marts.build_mart_load(load, forecast)


_FACTS = {
    "mart_lmps": (_build_lmps, schemas.MART_LMPS_KEY),
    "mart_load": (_build_load, schemas.MART_LOAD_KEY),
}
_stored: dict[tuple[str, str, str], str] = {}


def stored_fact(spark, sf_dir, name: str) -> DataFrame:
    """A fact as tiers and checks read it: a table on disk, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = _new_folder(spark, name)
        build, keys = _FACTS[name]
        write_history(path, build(spark, sf_dir), keys, HOUR, "month")
        _stored[key] = path
    return read_table(spark, _stored[key], merge_schema=False)


def _mart_lmps(spark, sf_dir):
    return stored_fact(spark, sf_dir, "mart_lmps").drop("month_utc")


def _mart_load(spark, sf_dir):
    return stored_fact(spark, sf_dir, "mart_load").drop("month_utc")


def stored_tiers(spark, sf_dir, *facts: str) -> series.Tiers:
    """The tiers of these facts (of all if none is named) as they are served: written once per application."""
    held = {}
    for fact in facts or _FACTS:
        key = (spark.sparkContext.applicationId, sf_dir, f"tiers of {fact}")
        if key not in _stored:
            path = _new_folder(spark, "tiers")
            tiers.write_tiers(path, **{fact: stored_fact(spark, sf_dir, fact).drop("month_utc")})
            _stored[key] = path
        found = series.read_tiers(spark, _stored[key])
        held |= {name: table for name, table in vars(found).items() if table is not None}
    return series.Tiers(**held)


# --- sources ---------------------------------------------------------------------


@query
def scan_feed_query(spark, sf_dir):
    path = _new_folder(spark, "scan")
    sinks.write_table(feeds.landed(spark, sf_dir, "da_lmps"), path)
    return scan_feed(spark, path, "da_lmps")


@query
def scan_mixed_schema(spark, sf_dir):
    """Two kinds of file in one place: one without source, one without components."""
    path = _new_folder(spark, "mixed")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    components = ["system_energy_price_da", "congestion_price_da", "marginal_loss_price_da"]
    api = feed.filter("source is null").drop("source", "pnode_type")
    backfill = feed.filter("source = 'eia'").drop("type", *components)
    sinks.write_table(api, f"{path}/api")
    sinks.write_table(backfill, f"{path}/backfill")
    return union_feeds(*[scan_feed(spark, f"{path}/{part}", "da_lmps") for part in ("api", "backfill")])


@query
def unwrap_pages(spark, sf_dir):
    """A page per day: bare lists, then objects with ``items``, then with ``data``."""
    path = _new_folder(spark, "pages")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    day = F.to_date(F.regexp_replace("datetime_beginning_ept", " .*", ""), "M/d/yyyy")
    iso_day = F.to_date(F.substring("datetime_beginning_ept", 1, 10))
    day = F.when(F.col("source").isNull(), day).otherwise(iso_day)
    # A day has at most 24 hours times 5 nodes, so a page is small.
    by_day = feed.groupBy(day.alias("day")).agg(F.collect_list(F.struct(*feed.columns)).alias("items"))
    kind = F.datediff("day", F.lit("1995-01-01")) % 3
    page = (
        F.when(kind == 0, F.to_json("items"))
        .when(kind == 1, F.to_json(F.struct("items")))
        .otherwise(F.to_json(F.struct(F.col("items").alias("data"))))
    )
    by_day.select(page.alias("value")).write.text(path)
    return pages.unwrap_pages(spark, path, "da_lmps", whole_file=False)


@query
def unwrap_pages_variant(spark, sf_dir):
    """Pages whose elements have a field that the feed does not know, and one element with nothing else."""
    path = _new_folder(spark, "variant-pages")
    feed = feeds.landed(spark, sf_dir, "da_lmps").withColumn("note", F.col("pnode_name"))
    day = F.to_date(wall_clock(F.col("datetime_beginning_ept")))
    only = F.struct(*[F.lit("only" if c == "note" else None).cast(t).alias(c) for c, t in feed.dtypes])
    items = F.concat(F.collect_list(F.struct(*feed.columns)), F.array(only)).alias("items")
    by_day = feed.groupBy(day.alias("day")).agg(items)
    page = F.when(F.dayofmonth("day") % 2 == 0, F.to_json("items")).otherwise(F.to_json(F.struct("items")))
    by_day.select(page.alias("value")).write.text(path)
    rows = pages.unwrap_pages(spark, path, "da_lmps", whole_file=False, element="element")
    note = F.variant_get("element", "$.note", "string").alias("note")
    return rows.select(*rows.drop("element").columns, note)


@query
def unwrap_pages_files(spark, sf_dir):
    """A file per page: a month of rows each."""
    path = _new_folder(spark, "page-files")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    month = F.date_format(wall_clock(F.col("datetime_beginning_ept")), "yyyy-MM")
    # A month has at most 744 hours times 5 nodes.
    by_month = feed.groupBy(month.alias("page")).agg(F.collect_list(F.struct(*feed.columns)).alias("items"))
    page = F.when(F.substring("page", -1, 1) == "1", F.to_json("items")).otherwise(F.to_json(F.struct("items")))
    rows = by_month.select(page.alias("value"), "page").repartition("page")
    rows.write.partitionBy("page").text(path)
    return pages.unwrap_pages(spark, path, "da_lmps")


def _csv(spark, sf_dir, name: str, columns: dict[str, str], feed: str = "da_lmps") -> DataFrame:
    """Write columns of a feed as CSV under other headers and read the files back."""
    path = _new_folder(spark, name)
    table = feeds.landed(spark, sf_dir, feed).select(*[F.col(c).alias(h) for h, c in columns.items()])
    writer = table.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return normalise.read_csv(spark, path)


_FLAT = {
    " Datetime Beginning": "datetime_beginning_ept",
    "Respondent": "pnode_id",
    "Zone-Name": "pnode_name",
    "LMP DA": "total_lmp_da",
    "Energy Price": "system_energy_price_da",
    "Congestion": "congestion_price_da",
    "Marginal Loss": "marginal_loss_price_da",
}


@query
def normalise_csv_flat(spark, sf_dir):
    return conform(normalise.normalise_da_zones(_csv(spark, sf_dir, "flat", _FLAT)), schemas.DA_FEED)


@query
def normalise_csv_hubs(spark, sf_dir):
    return conform(normalise.normalise_da_hubs(_csv(spark, sf_dir, "hubs", _FLAT)), schemas.DA_FEED)


@query
def normalise_csv_mixed(spark, sf_dir):
    """Three files of one folder, with their columns in different orders and layouts."""
    path = _new_folder(spark, "csv-mixed")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    turned = dict(reversed(_FLAT.items()))
    layouts = {"HUB": _FLAT, "ZONE": turned, "LOAD": _API_HEADERS}
    for kind, headers in layouts.items():
        rows = feed.filter(F.coalesce("type", "pnode_type") == kind)
        writer = rows.select(*[F.col(c).alias(h) for h, c in headers.items()]).write.mode("append")
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return conform(normalise.normalise_files(spark, path, normalise.normalise_da_zones), schemas.DA_FEED)


_API_HEADERS = {
    "period": "datetime_beginning_ept",
    "respondent": "pnode_id",
    "respondent-name": "pnode_name",
    "value": "total_lmp_da",
}


@query
def normalise_csv_rt(spark, sf_dir):
    headers = {
        "Period": "datetime_beginning_ept",
        "Respondent": "pnode_id",
        "Respondent-Name": "pnode_name",
        "RT LMP": "total_lmp_rt",
        "Energy": "system_energy_price_rt",
        "Congestion": "congestion_price_rt",
        "Loss": "marginal_loss_price_rt",
    }
    csv = _csv(spark, sf_dir, "rt", headers, "rt_lmps")
    return conform(normalise.normalise_rt_zones(csv), schemas.RT_FEED)


@query
def normalise_csv_api(spark, sf_dir):
    headers = {
        "period": "datetime_beginning_ept",
        "respondent": "pnode_id",
        "respondent-name": "pnode_name",
        "value": "total_lmp_da",
    }
    return conform(normalise.normalise_da_zones(_csv(spark, sf_dir, "api", headers)), schemas.DA_FEED)


@query
def feed_window_query(spark, sf_dir):
    return feed_window(feeds.landed(spark, sf_dir, "da_lmps"), "1998-01-01", "2000-12-31", type="ZONE")


# --- staging, dimensions, facts ----------------------------------------------------


@query
def stg_da(spark, sf_dir):
    return _da(spark, sf_dir)


@query
def stg_rt(spark, sf_dir):
    return _rt(spark, sf_dir)


@query
def stg_load(spark, sf_dir):
    return staging.stage_load(feeds.landed(spark, sf_dir, "load"))


@query
def stg_forecast_latest(spark, sf_dir):
    return staging.stage_forecast(feeds.landed(spark, sf_dir, "load_forecast"))


@query
def dim_pnode(spark, sf_dir):
    return dims.build_dim_pnode(_da(spark, sf_dir))


@query
def dim_calendar(spark, sf_dir):
    return dims.build_dim_calendar(_da(spark, sf_dir))


@query
def mart_lmps(spark, sf_dir):
    return _build_lmps(spark, sf_dir)


@query
def mart_load(spark, sf_dir):
    return _build_load(spark, sf_dir)


# --- tiers -------------------------------------------------------------------------


def bucketed_sides(spark, sf_dir, buckets: int = 8) -> list[DataFrame]:
    """Both staged feeds as tables dealt by hour and node alike."""
    out = []
    for side, rows in (("da", _da(spark, sf_dir)), ("rt", _rt(spark, sf_dir))):
        name = f"staged_{side}_{uuid.uuid4().hex}"
        catalog.save_bucketed(rows, name, schemas.MART_LMPS_KEY, buckets, _new_folder(spark, name))
        out.append(spark.table(name))
    return out


@query
def mart_lmps_bucketed(spark, sf_dir):
    """The price fact out of bucketed tables: a sort-merge join without a shuffle."""
    da, rt = bucketed_sides(spark, sf_dir)
    return marts.build_mart_lmps(da, rt.hint("merge"))


@query
def history_extent(spark, sf_dir):
    return tiers.history_extent(_mart_lmps(spark, sf_dir))


@query
def lmp_daily(spark, sf_dir):
    return tiers.lmp_daily(_mart_lmps(spark, sf_dir))


@query
def load_daily(spark, sf_dir):
    return tiers.load_daily(_mart_load(spark, sf_dir))


def _newest(feed: DataFrame):
    return feed.agg(F.max(us_wall_clock(F.col("datetime_beginning_ept")))).scalar()


@query
def tier_recent_rt(spark, sf_dir):
    """Takes the five-minute feed, since it has files; the hourly one would be next."""
    path = _new_folder(spark, "recent")
    sinks.write_feed(feeds.landed(spark, sf_dir, "rt_5min"), f"{path}/rt_5min")
    candidates = [("rt_5min", f"{path}/rt_5min"), ("rt_lmps", f"{path}/rt_lmps")]
    _feed, landed = first_landed(spark, candidates)
    return tiers.recent_rt(landed, _newest(landed))


@query
def tier_recent_da(spark, sf_dir):
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    return tiers.recent_da(feed, _newest(feed))


@query
def tier_recent_rolling(spark, sf_dir):
    """The recent tier moved along three times; some rows of the days it holds land late."""
    path = _new_folder(spark, "rolling")
    feed = feeds.landed(spark, sf_dir, "rt_5min")
    when = us_wall_clock(F.col("datetime_beginning_ept"))
    newest = feed.agg(F.max(when)).collect()[0][0]
    moves = [newest - timedelta(days=8), newest - timedelta(days=3), newest]
    late = F.minute(when) < 10
    landed = F.when(late, 2).when(when < F.lit(moves[0]), 0).when(when < F.lit(moves[1]), 1).otherwise(2)
    for number, as_of in enumerate(moves):
        sinks.write_feed(feed.filter(landed == number), f"{path}/rt_5min", part=f"part{number}")
        rolling.refresh_recent(
            spark, f"{path}/tier", "rt_5min", f"{path}/rt_5min", f"{path}/checkpoint", tiers.recent_rt, as_of
        )
    return rolling.read_recent(spark, f"{path}/tier", newest)


@query
def tier_half_year(spark, sf_dir):
    path = _new_folder(spark, "halves")
    tiers.write_half_years(_mart_lmps(spark, sf_dir), path)
    return spark.read.parquet(path)


# --- series and figures ------------------------------------------------------------


def _hourly(spark, sf_dir, location):
    return series.lmp_series(stored_tiers(spark, sf_dir, "mart_lmps"), *HOURLY_RANGE, location)


@query
def lmp_series_intraday(spark, sf_dir):
    rt, da = feeds.landed(spark, sf_dir, "rt_5min"), feeds.landed(spark, sf_dir, "da_recent")
    as_of = _newest(rt)
    stored = series.Tiers(
        rt_recent=tiers.recent_rt(rt, as_of), da_recent=tiers.recent_da(da, as_of)
    )
    return series.lmp_series(stored, *INTRADAY_RANGE, series.DUQ)


@query
def lmp_series_across_tiers(spark, sf_dir):
    """Seven days of which the recent tiers hold the last three; the others come from half-years."""
    rt, da = feeds.landed(spark, sf_dir, "rt_5min"), feeds.landed(spark, sf_dir, "da_recent")
    as_of = _newest(rt)
    mart = marts.build_mart_lmps(staging.stage_da(da), staging.stage_rt(rt))
    held = series.Tiers(
        rt_recent=tiers.recent_rt(rt, as_of, days=3),
        da_recent=tiers.recent_da(da, as_of, days=3),
        lmps=tiers.half_year_tier(mart),
    )
    return series.lmp_series_by_pieces(held, *INTRADAY_RANGE, series.DUQ, first_recent=date(2024, 1, 28))


@query
def lmp_series_hourly(spark, sf_dir):
    return _hourly(spark, sf_dir, series.WESTERN_HUB)


@query
def lmp_series_daily(spark, sf_dir):
    return series.lmp_series(stored_tiers(spark, sf_dir, "mart_lmps"), *DAILY_RANGE, series.DUQ)


@query
def load_series_daily(spark, sf_dir):
    return series.load_series(stored_tiers(spark, sf_dir, "mart_load"), *DAILY_RANGE, zone="duq")


@query
def load_series_hourly(spark, sf_dir):
    return series.load_series(stored_tiers(spark, sf_dir, "mart_load"), *HOURLY_RANGE, zone="duq")


@query
def kpi_prices(spark, sf_dir):
    return kpi.kpi_prices(_hourly(spark, sf_dir, series.WESTERN_HUB), mean=exact_mean())


@query
def kpi_load(spark, sf_dir):
    loads = series.load_series(stored_tiers(spark, sf_dir, "mart_load"), *HOURLY_RANGE, zone="duq")
    return kpi.kpi_load(loads, mean=exact_mean())


@query
def freshness(spark, sf_dir):
    return kpi.freshness(_hourly(spark, sf_dir, series.DUQ))


@query
def freshness_long(spark, sf_dir):
    """Every hour of the history, more than any display would ask for."""
    hours = series.lmp_series(stored_tiers(spark, sf_dir, "mart_lmps"), *DAILY_RANGE, series.DUQ, grain="hourly")
    return kpi.freshness(hours)


@query
def price_duration_curve(spark, sf_dir):
    """Over the whole day-ahead history."""
    prices = _da(spark, sf_dir).select(F.col("total_lmp_da").alias("da"))
    return kpi.duration_curve(prices)


@query
def price_duration_curve_by_node(spark, sf_dir):
    """A curve for every node over its whole history, in one pass; ranges small enough that nodes are cut."""
    prices = _da(spark, sf_dir).select("pnode_name", F.col("total_lmp_da").alias("da"))
    return kpi.duration_curve(prices, buckets=16, by=("pnode_name",))


@query
def spread_sign(spark, sf_dir):
    return kpi.with_spread_sign(_hourly(spark, sf_dir, series.DUQ))


# --- incremental maintenance, checks, sinks ------------------------------------------


@query
def incremental_filter(spark, sf_dir):
    da = _da(spark, sf_dir)
    stored = da.filter(F.col(HOUR) <= naive(CUT))
    return newer_than(da, stored, HOUR)


@query
def upsert_lmps(spark, sf_dir):
    """History up to the cut is stored; a batch that overlaps it replaces the common hours."""
    path = _new_folder(spark, "upsert")
    mart = _mart_lmps(spark, sf_dir)
    history = mart.filter(F.col(HOUR) <= naive(CUT)).withColumn("da_rt_spread", F.lit(None).cast("double"))
    write_history(path, history, schemas.MART_LMPS_KEY, HOUR, "month")
    stored = read_table(spark, path)
    batch = newer_than(mart, stored, HOUR, lookback_hours=OVERLAP_HOURS)
    sinks.write_table(batch, f"{path}-batch")  # the upsert replaces files that it is read from
    batch = spark.read.parquet(f"{path}-batch")
    for _ in range(2):  # the second run changes nothing
        upsert_table(spark, path, batch, schemas.MART_LMPS_KEY, HOUR, "month")
    return read_table(spark, path)


@query
def upsert_lmps_by_file(spark, sf_dir):
    """As above, in which only files with a key of the batch are written anew."""
    path = _new_folder(spark, "upsert-files")
    mart = _mart_lmps(spark, sf_dir)
    history = mart.filter(F.col(HOUR) <= naive(CUT)).withColumn("da_rt_spread", F.lit(None).cast("double"))
    write_history(path, history, schemas.MART_LMPS_KEY, HOUR, "month")
    batch = newer_than(mart, read_table(spark, path), HOUR, lookback_hours=OVERLAP_HOURS)
    upsert_files(spark, path, batch, schemas.MART_LMPS_KEY, HOUR, "month")
    return read_table(spark, path)


@query
def upsert_schema_evolution(spark, sf_dir):
    """The batch brings a column that the stored rows do not have."""
    mart = _mart_lmps(spark, sf_dir)
    stored = mart.filter(F.col(HOUR) <= naive(CUT)).drop("da_rt_spread")
    overlap = F.make_dt_interval(hours=F.lit(OVERLAP_HOURS))
    batch = mart.filter(F.col(HOUR) > naive(CUT) - overlap)
    return merge_frames(stored, batch, schemas.MART_LMPS_KEY)


@query
def refresh_mart_lmps(spark, sf_dir):
    """Part of the feeds is stored; the rest and an overlap come from feeds laid out by month."""
    return _refreshed(spark, sf_dir, marts.refresh_mart_lmps, _DA_RT)


@query
def refresh_mart_load(spark, sf_dir):
    return _refreshed(spark, sf_dir, marts.refresh_mart_load, _LOAD_FORECAST)


_LATE = ("1997-03-01", "1997-05-01")


def _late_prices(spark, sf_dir, tier: bool = False) -> str:
    """Two months of real-time prices land after all else. The fact, and the daily tier, follow what has landed."""
    path = _new_folder(spark, "late")
    time_col = "datetime_beginning_ept"
    rt = feeds.landed(spark, sf_dir, "rt_lmps")
    late = wall_clock(F.col(time_col)).between(*[F.lit(d).cast("timestamp_ntz") for d in _LATE])
    sinks.write_feed(feeds.landed(spark, sf_dir, "da_lmps"), f"{path}/da", time_col, "month")
    days: list = []
    for part, rows in (("feed", rt.filter(~late)), ("late", rt.filter(late))):
        sinks.write_feed(rows, f"{path}/rt", time_col, "month", part)
        days.clear()
        changes.refresh_changed_lmps(
            spark, f"{path}/fact", f"{path}/da", f"{path}/rt", f"{path}/checkpoint", "month", touched=days.extend
        )
        if tier:
            changes.refresh_daily(spark, f"{path}/fact", f"{path}/daily", None if part == "feed" else sorted(set(days)))
    return path


@query
def refresh_late_prices(spark, sf_dir):
    return read_table(spark, f"{_late_prices(spark, sf_dir)}/fact", merge_schema=False)


@query
def tiers_incremental(spark, sf_dir):
    """The daily tier after the late prices, of which only the touched days were made anew."""
    return changes.read_daily(spark, f"{_late_prices(spark, sf_dir, tier=True)}/daily")


def _catalog_table(spark, sf_dir) -> tuple[str, str]:
    """Part of the price fact by year as a catalog table, then the years that are missing."""
    name = f"fact_{uuid.uuid4().hex}"
    mart = _mart_lmps(spark, sf_dir).withColumn("year_utc", F.year(HOUR))
    catalog.save_table(mart.filter("year_utc < 1996"), name, "year_utc", _new_folder(spark, "catalog"), ["pnode_id", HOUR])
    catalog.add_missing_periods(mart.withColumn("zone", F.when(F.col("year_utc") >= 1996, F.col("zone"))), name, "year_utc")
    return name, "year_utc"


@query
def catalog_missing_periods(spark, sf_dir):
    """Stored years keep their rows; the batch has them without a zone."""
    return spark.table(_catalog_table(spark, sf_dir)[0])


@query
def catalog_extent(spark, sf_dir):
    """First and last year by the catalog's list, and the newest hour, of which one folder is read."""
    name, part = _catalog_table(spark, sf_dir)
    newest = catalog.newest_rows(spark, name, part).agg(F.max(HOUR).alias("newest_hour"))
    return catalog.extent(spark, name, part).join(newest, F.lit(True))


_DA_RT = {"da_lmps": "datetime_beginning_ept", "rt_lmps": "datetime_beginning_ept"}
_LOAD_FORECAST = {"load": "datetime_beginning_ept", "load_forecast": "forecast_datetime_beginning_ept"}


def _refreshed(spark, sf_dir, refresh, times) -> DataFrame:
    path = _new_folder(spark, "refresh")
    for name, time in times.items():
        sinks.write_feed(feeds.landed(spark, sf_dir, name), f"{path}/{name}", time, "month")
    scanned = [scan_feed(spark, f"{path}/{name}", name) for name in times]
    before = [df.filter(F.col("feed_month") < F.lit("1997-03-01").cast("date")) for df in scanned]
    for landed_so_far in (before, scanned):
        refresh(spark, f"{path}/fact", *landed_so_far, lookback_hours=OVERLAP_HOURS, unit="month")
    return read_table(spark, f"{path}/fact", merge_schema=False)


@query
def dq_not_null(spark, sf_dir):
    checks = [
        ("mart_lmps", _mart_lmps(spark, sf_dir), [*schemas.MART_LMPS_KEY, "total_lmp_da"]),
        ("mart_load", _mart_load(spark, sf_dir), [*schemas.MART_LOAD_KEY, "actual_load_mw"]),
        ("dim_pnode", dim_pnode(spark, sf_dir), ["pnode_id", "pnode_name"]),
        ("dim_calendar", dim_calendar(spark, sf_dir), ["hour_beginning_ept"]),
    ]
    found = [
        check_not_null(df, columns).withColumn("table_name", F.lit(name))
        for name, df, columns in checks
    ]
    return union_feeds(*found)


@query
def dq_while_writing(spark, sf_dir):
    """The counts of both facts, taken while they are written: no scan besides."""
    found = []
    for name, key in (("mart_lmps", schemas.MART_LMPS_KEY), ("mart_load", schemas.MART_LOAD_KEY)):
        columns = [*key, "total_lmp_da" if name == "mart_lmps" else "actual_load_mw"]
        rows, seen = observed(_FACTS[name][0](spark, sf_dir), columns)
        write_history(_new_folder(spark, "observed"), rows, key, HOUR, "month")
        found += [(name, column, violations) for column, violations in seen.get.items()]
    return spark.createDataFrame(found, "table_name string, column_name string, violations long")


@query
def dq_unique(spark, sf_dir):
    checks = [
        ("mart_lmps", _mart_lmps(spark, sf_dir), schemas.MART_LMPS_KEY),
        ("mart_load", _mart_load(spark, sf_dir), schemas.MART_LOAD_KEY),
        ("dim_pnode", dim_pnode(spark, sf_dir), ["pnode_id"]),
        ("dim_calendar", dim_calendar(spark, sf_dir), ["hour_beginning_ept"]),
    ]
    found = [
        check_unique(df, keys).agg(F.count("*").alias("duplicated_keys")).withColumn("table_name", F.lit(name))
        for name, df, keys in checks
    ]
    return union_feeds(*found)


@query
def sink_roundtrip(spark, sf_dir):
    """Land a feed by month, then land part of it again; the rerun replaces its own months."""
    path = _new_folder(spark, "sink")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    sinks.write_feed(feed, path, unit="month")
    sinks.write_feed(feed.filter("source is null"), path, unit="month")
    return scan_feed(spark, path, "da_lmps")


@query
def sink_two_sources(spark, sf_dir):
    """Three parts of one feed share days; landing one of them again leaves the others alone."""
    path = _new_folder(spark, "parts")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    kind = F.coalesce("type", "pnode_type")
    parts = {"zones": kind == "ZONE", "hubs": kind == "HUB", "other": kind == "LOAD"}
    for name in (*parts, "hubs"):
        sinks.write_feed(feed.filter(parts[name]), path, unit="month", part=name)
    return scan_feed(spark, path, "da_lmps").drop("feed_month")


@query
def backfill_missing_periods(spark, sf_dir):
    """Years already stored keep their rows; the others are added."""
    path = _new_folder(spark, "backfill")
    feed = feeds.landed(spark, sf_dir, "da_lmps")
    year = F.year(wall_clock(F.col("datetime_beginning_ept")))
    feed = feed.withColumn("period", year.cast("string"))
    first_load = feed.filter("period = '1996'").withColumn("source", F.lit("kept"))
    sinks.write_missing_periods(first_load, path, "period")
    sinks.write_missing_periods(feed, path, "period")
    return scan_feed(spark, path, "da_lmps")


@query
def stream_upsert_query(spark, sf_dir):
    """The five-minute feed lands twice, first with other prices; the later files win."""
    folder = _new_folder(spark, "stream")
    for factor in (2.0, 1.0):
        _land_prices(spark, sf_dir, folder, factor)
        _run_stream(spark, folder)
    return read_table(spark, f"{folder}/table")


@query
def stream_backlog(spark, sf_dir):
    """Both landings wait before the one call that takes them."""
    folder = _new_folder(spark, "backlog")
    for factor in (2.0, 1.0):
        _land_prices(spark, sf_dir, folder, factor)
    _run_stream(spark, folder)
    return read_table(spark, f"{folder}/table")


def _land_prices(spark, sf_dir, folder: str, factor: float) -> None:
    """Rows without a readable id keep their price, as they can't be told apart later."""
    feed = feeds.landed(spark, sf_dir, "rt_5min")
    price = F.col("total_lmp_rt")
    priced = feed.withColumn("total_lmp_rt", F.when(F.col("pnode_id") == "N/A", price).otherwise(price * factor))
    time.sleep(1.1)  # file times in whole seconds still tell the landings apart
    priced.write.mode("append").parquet(f"{folder}/landed")


def _run_stream(spark, folder: str, files_per_batch: int = 1000) -> None:
    stream_upsert(
        spark,
        f"{folder}/landed",
        schemas.RT_FEED,
        staging.stage_rt,
        target=f"{folder}/table",
        keys=schemas.MART_LMPS_KEY,
        time_col=HOUR,
        checkpoint=f"{folder}/checkpoint",
        files_per_batch=files_per_batch,
    )


# Query keys that would clash with the name of the function they exercise.
for _key in ("scan_feed", "feed_window", "stream_upsert"):
    _REGISTERED[_key] = _REGISTERED.pop(f"{_key}_query")
