"""The same results as SQL for DuckDB, written independently of the Spark code.

Each oracle is a WITH list of the relations it needs and a final SELECT.
"""

from __future__ import annotations

_LINES = """
lines AS (
  SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS h, l_suppkey % 5 AS k, *
  FROM lineitem
)"""

_NODES = """
nodes(k, id, node, kind, area) AS (
  VALUES (0, '51217', 'WESTERN HUB', 'HUB', NULL), (1, '50001', 'DUQ', 'ZONE', 'DUQ'),
         (2, '50002', 'AEP', 'ZONE', 'AEP'), (3, '50003', ' PECO ', 'ZONE', ' PECO '),
         (4, 'N/A', 'NODE_4', 'LOAD', 'NODE')
)"""


def _text(ts: str, hour: str = "h") -> str:
    return (
        f"if(year({hour}) >= 1998, strftime({ts}, '%-m/%-d/%Y %-H:%M'),"
        f" strftime({ts}, '%Y-%m-%d %H:%M:%S'))"
    )


_DA_FEED = f"""
da_feed AS (
  SELECT {_text("h")} AS datetime_beginning_ept, id AS pnode_id, node AS pnode_name,
         if(year(h) >= 1998, kind, NULL) AS type, if(year(h) < 1998, kind, NULL) AS pnode_type,
         area AS zone, if(year(h) < 1998, 'eia', NULL) AS source,
         min(l_quantity) AS system_energy_price_da, max(l_discount) AS congestion_price_da,
         max(l_tax) AS marginal_loss_price_da, min(l_extendedprice) / 1000 AS total_lmp_da
  FROM lines JOIN nodes USING (k) GROUP BY h, id, node, kind, area
)"""

_RT_FEED = f"""
rt_feed AS (
  SELECT {_text("h")} AS datetime_beginning_ept, id AS pnode_id, node AS pnode_name,
         kind AS type, area AS zone,
         min(l_quantity) AS system_energy_price_rt, max(l_discount) AS congestion_price_rt,
         max(l_tax) AS marginal_loss_price_rt, max(l_extendedprice) / 1000 AS total_lmp_rt
  FROM lines JOIN nodes USING (k) WHERE l_quantity > 20 GROUP BY h, id, node, kind, area
)"""

_LOAD_FEED = f"""
load_feed AS (
  SELECT {_text("h")} AS datetime_beginning_ept, ' ' || lower(node) || ' ' AS zone,
         node AS load_area, ' RFC ' AS nerc_region, if(k % 2 = 0, 'true', '0') AS is_verified,
         sum(l_quantity) AS mw
  FROM lines JOIN nodes USING (k) GROUP BY h, k, node
)"""

_FORECAST_FEED = f"""
forecast_feed AS (
  SELECT {_text("o_orderdate")} AS evaluated_at_datetime_ept,
         {_text("h")} AS forecast_datetime_beginning_ept,
         node AS forecast_area, 2 * l_quantity AS forecast_load_mw
  FROM lines JOIN nodes USING (k) JOIN orders ON o_orderkey = l_orderkey
)"""


def _event_feed(name: str, slot: str, suffix: str, total: str) -> str:
    return f"""
{name} AS (
  SELECT strftime(slot, '%-m/%-d/%Y %-H:%M') AS datetime_beginning_ept, id AS pnode_id,
         node AS pnode_name, kind AS type, area AS zone,
         min(value) AS congestion_price_{suffix}, max(value) AS marginal_loss_price_{suffix},
         {total} AS total_lmp_{suffix}
  FROM (SELECT {slot} AS slot, user_id % 5 AS k, value FROM events) JOIN nodes USING (k)
  GROUP BY slot, id, node, kind, area
)"""


def _mean(x: str, scale: int = 5) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE) / count({x})"


_RT_5MIN = _event_feed(
    "rt_5min", "time_bucket(INTERVAL '5 minutes', ts)", "rt", _mean("value", 2)
)
_DA_EVENTS = _event_feed("da_events", "date_trunc('hour', ts)", "da", "max(value)")


def _local(text: str) -> str:
    return f"coalesce(try_strptime({text}, '%m/%d/%Y %H:%M'), try_cast({text} AS TIMESTAMP))"


def _utc(text: str) -> str:
    local = _local(text)
    return (
        f"if(contains({text}, '/'),"
        f" ({local} AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', {local})"
    )


def _stage_prices(name: str, feed: str, s: str, kind: str, extra: str = "") -> str:
    text = "datetime_beginning_ept"
    return f"""
{name} AS (
  SELECT {_local(text)} AS hour_beginning_ept, {_utc(text)} AS hour_beginning_utc,
         try_cast(pnode_id AS INTEGER) AS pnode_id, trim(pnode_name) AS pnode_name,
         {kind} AS pnode_type, trim(zone) AS zone,
         system_energy_price_{s} AS energy_price_{s}, congestion_price_{s},
         marginal_loss_price_{s} AS loss_price_{s}, total_lmp_{s}{extra}
  FROM {feed} WHERE total_lmp_{s} IS NOT NULL
)"""


_STG_DA = _stage_prices(
    "stg_da", "da_feed", "da", "trim(coalesce(type, pnode_type))", ", ifnull(source, 'pjm') AS source"
)
_STG_RT = _stage_prices("stg_rt", "rt_feed", "rt", "trim(type)")
_STG_5MIN = _stage_prices(
    "stg_5min",
    "(SELECT *, CAST(NULL AS DOUBLE) AS system_energy_price_rt FROM rt_5min)",
    "rt",
    "trim(type)",
)
_STG_LOAD = f"""
stg_load AS (
  SELECT {_local("datetime_beginning_ept")} AS hour_beginning_ept,
         {_utc("datetime_beginning_ept")} AS hour_beginning_utc,
         trim(zone) AS zone, trim(load_area) AS load_area, trim(nerc_region) AS nerc_region,
         CAST(NULL AS VARCHAR) AS mkt_region, mw AS load_mw,
         try_cast(is_verified AS BOOLEAN) AS is_verified
  FROM load_feed WHERE mw IS NOT NULL
)"""
_STG_FORECAST = f"""
stg_forecast AS (
  SELECT * FROM (
    SELECT {_local("evaluated_at_datetime_ept")} AS evaluated_at_ept,
           {_local("forecast_datetime_beginning_ept")} AS forecast_hour_ept,
           {_utc("forecast_datetime_beginning_ept")} AS forecast_hour_utc,
           trim(forecast_area) AS forecast_area, forecast_load_mw
    FROM forecast_feed)
  QUALIFY row_number() OVER (
    PARTITION BY forecast_area, forecast_hour_utc
    ORDER BY evaluated_at_ept DESC NULLS LAST, forecast_load_mw DESC NULLS LAST,
             forecast_hour_ept DESC NULLS LAST) = 1
)"""
_MART_LMPS = """
mart_lmps AS (
  SELECT d.hour_beginning_utc, d.hour_beginning_ept, d.pnode_id, d.pnode_name, d.pnode_type, d.zone,
         energy_price_da, congestion_price_da, loss_price_da, total_lmp_da,
         energy_price_rt, congestion_price_rt, loss_price_rt, total_lmp_rt,
         total_lmp_da - total_lmp_rt AS da_rt_spread
  FROM stg_da d LEFT JOIN stg_rt r
    ON r.hour_beginning_utc = d.hour_beginning_utc AND r.pnode_id = d.pnode_id
)"""
_MART_LOAD = """
mart_load AS (
  SELECT hour_beginning_utc, hour_beginning_ept, zone, load_area, load_mw AS actual_load_mw,
         is_verified, forecast_load_mw, load_mw - forecast_load_mw AS forecast_error_mw,
         if(forecast_load_mw <> 0, (load_mw - forecast_load_mw) / forecast_load_mw * 100.0, NULL)
           AS forecast_error_pct
  FROM stg_load LEFT JOIN stg_forecast
    ON forecast_hour_utc = hour_beginning_utc AND upper(forecast_area) = upper(zone)
)"""
_DIM_PNODE = """
dim_pnode AS (
  SELECT DISTINCT pnode_id, pnode_name, pnode_type, zone,
         CASE WHEN pnode_id = 51217 THEN 'Western Hub'
              WHEN zone = 'DUQ' AND pnode_type = 'ZONE' THEN 'DUQ Zone'
              ELSE pnode_name END AS display_name,
         CASE pnode_type WHEN 'HUB' THEN 'Hub' WHEN 'ZONE' THEN 'Zone' ELSE 'Other' END AS pnode_group
  FROM stg_da WHERE pnode_id IS NOT NULL
)"""
_DIM_CALENDAR = """
dim_calendar AS (
  SELECT t AS hour_beginning_ept, CAST(t AS DATE) AS date_ept, year(t) AS year, month(t) AS month,
         day(t) AS day, hour(t) AS hour_of_day, dayofweek(t) AS day_of_week,
         dayname(t) AS day_name, monthname(t) AS month_name,
         isodow(t) <= 5 AND hour(t) >= 6 AND hour(t) <= 21 AS is_peak
  FROM (SELECT min(hour_beginning_ept) AS a, max(hour_beginning_ept) AS b FROM stg_da),
       LATERAL (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS t)
)"""
_LMP_DAILY = """
lmp_daily AS (
  SELECT CAST(hour_beginning_utc AS DATE) AS date_utc, pnode_id, pnode_name, zone,
         CAST(avg(total_lmp_da) AS REAL) AS avg_lmp_da, CAST(avg(total_lmp_rt) AS REAL) AS avg_lmp_rt,
         CAST(min(total_lmp_da) AS REAL) AS min_lmp_da, CAST(max(total_lmp_da) AS REAL) AS max_lmp_da,
         CAST(avg(da_rt_spread) AS REAL) AS avg_spread, count(*) AS hours
  FROM mart_lmps GROUP BY date_utc, pnode_id, pnode_name, zone
)"""
_LOAD_DAILY = """
load_daily AS (
  SELECT CAST(hour_beginning_utc AS DATE) AS date_utc, zone,
         CAST(avg(actual_load_mw) AS REAL) AS avg_load_mw,
         CAST(max(actual_load_mw) AS REAL) AS peak_load_mw,
         CAST(avg(forecast_load_mw) AS REAL) AS avg_forecast_mw,
         CAST(avg(abs(forecast_error_pct)) AS REAL) AS avg_forecast_err_pct
  FROM mart_load GROUP BY date_utc, zone
)"""
_HALVES = """
halves AS (
  SELECT hour_beginning_utc, pnode_id, pnode_name, zone, CAST(total_lmp_da AS REAL) AS total_lmp_da,
         CAST(total_lmp_rt AS REAL) AS total_lmp_rt, CAST(da_rt_spread AS REAL) AS da_rt_spread,
         year(hour_beginning_utc) || 'H' || if(quarter(hour_beginning_utc) <= 2, 1, 2) AS half
  FROM mart_lmps
)"""


def _recent(name: str, feed: str, columns: str) -> str:
    when = "try_strptime(datetime_beginning_ept, '%m/%d/%Y %H:%M')"
    return f"""
{name} AS (
  SELECT datetime_beginning_ept, try_cast(pnode_id AS INTEGER) AS pnode_id,
         trim(pnode_name) AS pnode_name, trim(coalesce(zone, pnode_name)) AS zone, {columns}
  FROM {feed} WHERE {when} >= (SELECT max({when}) FROM {feed}) - INTERVAL 7 DAY
)"""


_RT_COLUMNS = (
    "CAST(total_lmp_rt AS REAL) AS total_lmp_rt, CAST(congestion_price_rt AS REAL) AS congestion_rt,"
    " CAST(marginal_loss_price_rt AS REAL) AS loss_rt"
)
_DA_COLUMNS = "CAST(total_lmp_da AS REAL) AS total_lmp_da"

_DA = [_LINES, _NODES, _DA_FEED, _STG_DA]
_RT = [_RT_FEED, _STG_RT]
_LMPS = [*_DA, *_RT, _MART_LMPS]
_LOAD = [_LINES, _NODES, _LOAD_FEED, _STG_LOAD, _FORECAST_FEED, _STG_FORECAST, _MART_LOAD]

_HUB = "pnode_id = 51217"
_DUQ = "zone = 'DUQ' AND pnode_id <> 51217"
_HOURS = (
    "hour_beginning_utc >= TIMESTAMP '1998-03-01' AND hour_beginning_utc < TIMESTAMP '1998-09-01'"
)


def _series(table: str, ts: str, da: str, rt: str, spread: str, where: str) -> str:
    return f"""
series AS (
  SELECT {ts} AS ts, avg(CAST({da} AS DOUBLE)) AS da, avg(CAST({rt} AS DOUBLE)) AS rt,
         avg(CAST({spread} AS DOUBLE)) AS spread
  FROM {table} WHERE {where} GROUP BY 1
)"""


def _hour_series(place: str) -> str:
    columns = ("total_lmp_da", "total_lmp_rt", "da_rt_spread")
    return _series("halves", "hour_beginning_utc", *columns, f"{_HOURS} AND {place}")


_DAY_SERIES = _series(
    "lmp_daily",
    "CAST(date_utc AS TIMESTAMP)",
    "avg_lmp_da",
    "avg_lmp_rt",
    "avg_spread",
    f"date_utc BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' AND {_DUQ}",
)
_INTRADAY = """
intraday AS (
  SELECT rt_time AS t, r.pnode_id, r.zone, total_lmp_da, total_lmp_rt,
         total_lmp_da - total_lmp_rt AS da_rt_spread
  FROM (SELECT *, strptime(datetime_beginning_ept, '%m/%d/%Y %H:%M') AS rt_time FROM rt_recent) r
  LEFT JOIN (SELECT *, strptime(datetime_beginning_ept, '%m/%d/%Y %H:%M') AS da_time FROM da_recent) d
    ON d.da_time = rt_time AND d.pnode_id = r.pnode_id
)"""
_INTRADAY_SERIES = _series(
    "intraday",
    "t",
    "total_lmp_da",
    "total_lmp_rt",
    "da_rt_spread",
    f"t >= TIMESTAMP '2024-01-24' AND t < TIMESTAMP '2024-01-31' AND {_DUQ}",
)
_LOAD_HOURS = f"""
loads AS (
  SELECT hour_beginning_utc AS ts, actual_load_mw AS actual, forecast_load_mw AS forecast,
         actual_load_mw AS peak
  FROM mart_load WHERE zone = 'duq' AND {_HOURS}
)"""
_LOAD_DAYS = """
loads AS (
  SELECT CAST(date_utc AS TIMESTAMP) AS ts, CAST(avg_load_mw AS DOUBLE) AS actual,
         CAST(avg_forecast_mw AS DOUBLE) AS forecast, CAST(peak_load_mw AS DOUBLE) AS peak
  FROM load_daily
  WHERE zone = 'duq' AND date_utc BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
)"""

# Without source the file of the API part, without components that of the backfill part.
_MIXED = """
SELECT datetime_beginning_ept, pnode_id, pnode_name, type, pnode_type, zone, source, total_lmp_da,
       if(source IS NULL, system_energy_price_da, NULL) AS system_energy_price_da,
       if(source IS NULL, congestion_price_da, NULL) AS congestion_price_da,
       if(source IS NULL, marginal_loss_price_da, NULL) AS marginal_loss_price_da
FROM da_feed"""


def _csv(suffix: str, feed: str, kind: str, components: bool = True) -> str:
    parts = [f"{c}_{suffix}" for c in ("system_energy_price", "congestion_price", "marginal_loss_price")]
    shown = ", ".join(p if components else f"CAST(NULL AS DOUBLE) AS {p}" for p in parts)
    return (
        "SELECT datetime_beginning_ept, nullif(pnode_id, 'N/A') AS pnode_id, pnode_name,"
        f" '{kind}' AS type, '{kind}' AS pnode_type, pnode_name AS zone, 'eia' AS source,"
        f" {shown}, total_lmp_{suffix} FROM {feed}"
    )


_CUT = "TIMESTAMP '1999-06-30'"
_BATCH = f"hour_beginning_utc > {_CUT} - INTERVAL 720 HOUR"


def _upserted(batch: str, same: str) -> str:
    """Stored rows lack the spread; rows of the batch have it and replace equal keys.

    A row without an id matches no key, but where it comes again just as it is (``same``), it
    is stored once.
    """
    return f"""
batch AS (SELECT * FROM mart_lmps WHERE {batch}),
stored AS (
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS da_rt_spread)
  FROM mart_lmps WHERE hour_beginning_utc <= {_CUT}
),
merged AS (
  SELECT * FROM stored s WHERE NOT EXISTS (
    SELECT 1 FROM batch b
    WHERE b.hour_beginning_utc = s.hour_beginning_utc AND (b.pnode_id = s.pnode_id OR {same}))
  UNION ALL SELECT * FROM batch
)"""


# The batch starts before the newest stored hour, which may lie before the cut.
_UPSERT_BATCH = f"""hour_beginning_utc > (
  SELECT max(hour_beginning_utc) FROM mart_lmps WHERE hour_beginning_utc <= {_CUT}
) - INTERVAL 720 HOUR"""


_SAME = (
    "b.pnode_id IS NULL AND s.pnode_id IS NULL AND s.pnode_name = b.pnode_name"
    " AND s.total_lmp_da = b.total_lmp_da"
)
# the stored rows have a spread of NULL there
_SAME_WITH_SPREAD = f"{_SAME} AND b.da_rt_spread IS NULL"


_STG_DA_EVENTS = _stage_prices(
    "stg_da_events", "(SELECT *, CAST(NULL AS DOUBLE) AS system_energy_price_da FROM da_events)", "da", "trim(type)"
)
_EDGE = "TIMESTAMP '2024-01-28'"  # the first whole day of the recent tiers
_ACROSS = f"""
event_halves AS (
  SELECT d.hour_beginning_utc, d.pnode_id, d.zone, CAST(total_lmp_da AS REAL) AS total_lmp_da,
         CAST(total_lmp_rt AS REAL) AS total_lmp_rt, CAST(total_lmp_da - total_lmp_rt AS REAL) AS da_rt_spread
  FROM stg_da_events d LEFT JOIN stg_5min r
    ON r.hour_beginning_utc = d.hour_beginning_utc AND r.pnode_id = d.pnode_id
),
priced AS (
  SELECT t AS ts, total_lmp_da, total_lmp_rt, da_rt_spread, 'intraday' AS grain FROM intraday
  WHERE t >= {_EDGE} AND t < TIMESTAMP '2024-01-31' AND {_DUQ}
  UNION ALL
  SELECT hour_beginning_utc, total_lmp_da, total_lmp_rt, da_rt_spread, 'hourly' FROM event_halves
  WHERE hour_beginning_utc >= TIMESTAMP '2024-01-24' AND hour_beginning_utc < {_EDGE} AND {_DUQ}
)"""


def _nulls(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name,"
        f" count(*) FILTER ({c} IS NULL) AS violations FROM {table}"
        for c in columns
    )


def _repeats(table: str, *keys: str) -> str:
    listed, present = ", ".join(keys), " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{table}' AS table_name, count(*) AS duplicated_keys FROM (SELECT 1 FROM {table}"
        f" WHERE {present} GROUP BY {listed} HAVING count(*) > 1)"
    )


_CHECKED = [*_LMPS, *_LOAD[2:], _DIM_PNODE, _DIM_CALENDAR]

_CURVE = """
SELECT floor((row_number() OVER (ORDER BY total_lmp_da DESC) - 1)
             / nullif(count(*) OVER () - 1, 0) * 100 * 10 + 0.5) / 10 AS pct_of_hours,
       total_lmp_da AS price
FROM stg_da"""

_DA_FEED_ONLY = [_LINES, _NODES, _DA_FEED]
_RT_5MIN_ONLY = [_NODES, _RT_5MIN]

_RELATIONS_AND_SELECT: dict[str, tuple[list[str], str]] = {
    "scan_feed": (_DA_FEED_ONLY, "SELECT * FROM da_feed"),
    "scan_mixed_schema": (_DA_FEED_ONLY, _MIXED),
    "unwrap_pages": (_DA_FEED_ONLY, "SELECT * FROM da_feed"),
    "unwrap_pages_variant": (
        _DA_FEED_ONLY,
        "SELECT *, pnode_name AS note FROM da_feed UNION ALL BY NAME"
        f" SELECT DISTINCT ON (CAST({_local('datetime_beginning_ept')} AS DATE)) 'only' AS note FROM da_feed",
    ),
    "unwrap_pages_files": (_DA_FEED_ONLY, "SELECT * FROM da_feed"),
    "normalise_csv_mixed": (
        _DA_FEED_ONLY,
        _csv("da", "da_feed", "ZONE")
        + " WHERE coalesce(type, pnode_type) <> 'LOAD' UNION ALL "
        + _csv("da", "da_feed", "ZONE", components=False)
        + " WHERE coalesce(type, pnode_type) = 'LOAD'",
    ),
    "normalise_csv_flat": (_DA_FEED_ONLY, _csv("da", "da_feed", "ZONE")),
    "normalise_csv_hubs": (_DA_FEED_ONLY, _csv("da", "da_feed", "HUB")),
    "normalise_csv_rt": ([_LINES, _NODES, _RT_FEED], _csv("rt", "rt_feed", "ZONE")),
    "normalise_csv_api": (_DA_FEED_ONLY, _csv("da", "da_feed", "ZONE", components=False)),
    "feed_window": (
        _DA_FEED_ONLY,
        f"SELECT * FROM da_feed WHERE type = 'ZONE' AND {_local('datetime_beginning_ept')}"
        " BETWEEN TIMESTAMP '1998-01-01 00:00' AND TIMESTAMP '2000-12-31 23:00'",
    ),
    "stg_da": (_DA, "SELECT * FROM stg_da"),
    "stg_rt": ([_LINES, _NODES, *_RT], "SELECT * FROM stg_rt"),
    "stg_load": ([_LINES, _NODES, _LOAD_FEED, _STG_LOAD], "SELECT * FROM stg_load"),
    "stg_forecast_latest": (
        [_LINES, _NODES, _FORECAST_FEED, _STG_FORECAST],
        "SELECT * FROM stg_forecast",
    ),
    "dim_pnode": ([*_DA, _DIM_PNODE], "SELECT * FROM dim_pnode"),
    "dim_calendar": ([*_DA, _DIM_CALENDAR], "SELECT * FROM dim_calendar"),
    "mart_lmps": (_LMPS, "SELECT * FROM mart_lmps"),
    "mart_lmps_bucketed": (_LMPS, "SELECT * FROM mart_lmps"),
    "mart_load": (_LOAD, "SELECT * FROM mart_load"),
    "history_extent": (
        _LMPS,
        "SELECT CAST(min(hour_beginning_utc) AS DATE) AS min_date,"
        " CAST(max(hour_beginning_utc) AS DATE) AS max_date FROM mart_lmps",
    ),
    "lmp_daily": ([*_LMPS, _LMP_DAILY], "SELECT * FROM lmp_daily"),
    "load_daily": ([*_LOAD, _LOAD_DAILY], "SELECT * FROM load_daily"),
    "tier_recent_rt": (
        [*_RT_5MIN_ONLY, _recent("rt_recent", "rt_5min", _RT_COLUMNS)],
        "SELECT * FROM rt_recent",
    ),
    "tier_recent_rolling": (
        [*_RT_5MIN_ONLY, _recent("rt_recent", "rt_5min", _RT_COLUMNS)],
        "SELECT * FROM rt_recent",
    ),
    "tier_recent_da": (
        [*_DA_FEED_ONLY, _recent("da_recent", "da_feed", _DA_COLUMNS)],
        "SELECT * FROM da_recent",
    ),
    "tier_half_year": ([*_LMPS, _HALVES], "SELECT * FROM halves"),
    "lmp_series_intraday": (
        [
            *_RT_5MIN_ONLY,
            _DA_EVENTS,
            _recent("rt_recent", "rt_5min", _RT_COLUMNS),
            # the day-ahead extract is cut at the newest real-time row
            _recent("da_recent", "da_events", _DA_COLUMNS).replace(
                "FROM da_events) -", "FROM rt_5min) -"
            ),
            _INTRADAY,
            _INTRADAY_SERIES,
        ],
        "SELECT * FROM series",
    ),
    "lmp_series_across_tiers": (
        [
            *_RT_5MIN_ONLY,
            _DA_EVENTS,
            _recent("rt_recent", "rt_5min", _RT_COLUMNS).replace("7 DAY", "3 DAY"),
            _recent("da_recent", "da_events", _DA_COLUMNS)
            .replace("FROM da_events) -", "FROM rt_5min) -")
            .replace("7 DAY", "3 DAY"),
            _INTRADAY,
            _STG_DA_EVENTS,
            _STG_5MIN,
            _ACROSS,
        ],
        "SELECT ts, avg(CAST(total_lmp_da AS DOUBLE)) AS da, avg(CAST(total_lmp_rt AS DOUBLE)) AS rt,"
        " avg(CAST(da_rt_spread AS DOUBLE)) AS spread, grain FROM priced GROUP BY ts, grain",
    ),
    "lmp_series_hourly": ([*_LMPS, _HALVES, _hour_series(_HUB)], "SELECT * FROM series"),
    "lmp_series_daily": ([*_LMPS, _LMP_DAILY, _DAY_SERIES], "SELECT * FROM series"),
    "load_series_daily": ([*_LOAD, _LOAD_DAILY, _LOAD_DAYS], "SELECT * FROM loads"),
    "load_series_hourly": ([*_LOAD, _LOAD_HOURS], "SELECT * FROM loads"),
    "kpi_prices": (
        [*_LMPS, _HALVES, _hour_series(_HUB)],
        f"SELECT {_mean('da')} AS avg_da, {_mean('rt')} AS avg_rt, {_mean('spread')} AS avg_spread"
        " FROM series",
    ),
    "kpi_load": (
        [*_LOAD, _LOAD_HOURS],
        "SELECT max(coalesce(peak, 0)) AS peak_load, "
        + _mean("abs((actual - forecast) / nullif(actual, 0)) * 100")
        + " AS mape FROM loads",
    ),
    "freshness": (
        [*_LMPS, _HALVES, _hour_series(_DUQ)],
        "SELECT max(ts) AS latest_ts, count(*) AS row_count FROM series",
    ),
    "freshness_long": (
        [*_LMPS, _HALVES],
        "SELECT max(hour_beginning_utc) AS latest_ts, count(DISTINCT hour_beginning_utc) AS row_count"
        f" FROM halves WHERE {_DUQ} AND hour_beginning_utc >= TIMESTAMP '1995-01-01'"
        " AND hour_beginning_utc < TIMESTAMP '2002-01-01'",
    ),
    "price_duration_curve": (_DA, _CURVE),
    "price_duration_curve_by_node": (
        _DA,
        _CURVE.replace("SELECT floor", "SELECT pnode_name, floor")
        .replace("OVER (ORDER BY", "OVER (PARTITION BY pnode_name ORDER BY")
        .replace("OVER ()", "OVER (PARTITION BY pnode_name)"),
    ),
    "spread_sign": (
        [*_LMPS, _HALVES, _hour_series(_DUQ)],
        "SELECT *, CASE WHEN spread IS NULL THEN 'na' WHEN spread < 0 THEN 'neg' ELSE 'pos' END AS sign"
        " FROM series",
    ),
    "incremental_filter": (
        _DA,
        "SELECT * FROM stg_da WHERE hour_beginning_utc > (SELECT max(hour_beginning_utc) FROM stg_da"
        f" WHERE hour_beginning_utc <= {_CUT})",
    ),
    "upsert_lmps": (
        [*_LMPS, _upserted(_UPSERT_BATCH, _SAME_WITH_SPREAD)],
        "SELECT *, CAST(date_trunc('month', hour_beginning_utc) AS DATE) AS month_utc FROM merged",
    ),
    "upsert_lmps_by_file": (
        [*_LMPS, _upserted(_UPSERT_BATCH, _SAME_WITH_SPREAD)],
        "SELECT *, CAST(date_trunc('month', hour_beginning_utc) AS DATE) AS month_utc FROM merged",
    ),
    "upsert_schema_evolution": ([*_LMPS, _upserted(_BATCH, _SAME)], "SELECT * FROM merged"),
    "refresh_mart_lmps": (
        _LMPS,
        "SELECT *, CAST(date_trunc('month', hour_beginning_utc) AS DATE) AS month_utc FROM mart_lmps",
    ),
    "refresh_mart_load": (
        _LOAD,
        "SELECT *, CAST(date_trunc('month', hour_beginning_utc) AS DATE) AS month_utc FROM mart_load",
    ),
    "refresh_late_prices": (
        _LMPS,
        "SELECT *, CAST(date_trunc('month', hour_beginning_utc) AS DATE) AS month_utc FROM mart_lmps",
    ),
    "tiers_incremental": ([*_LMPS, _LMP_DAILY], "SELECT * FROM lmp_daily"),
    "catalog_missing_periods": (
        _LMPS,
        "SELECT *, CAST(year(hour_beginning_utc) AS INTEGER) AS year_utc FROM mart_lmps",
    ),
    "catalog_extent": (
        _LMPS,
        "SELECT CAST(min(year(hour_beginning_utc)) AS VARCHAR) AS first_period,"
        " CAST(max(year(hour_beginning_utc)) AS VARCHAR) AS last_period,"
        " max(hour_beginning_utc) AS newest_hour FROM mart_lmps",
    ),
    "dq_not_null": (
        _CHECKED,
        " UNION ALL ".join(
            [
                _nulls("mart_lmps", "hour_beginning_utc", "pnode_id", "total_lmp_da"),
                _nulls("mart_load", "hour_beginning_utc", "zone", "actual_load_mw"),
                _nulls("dim_pnode", "pnode_id", "pnode_name"),
                _nulls("dim_calendar", "hour_beginning_ept"),
            ]
        ),
    ),
    "dq_while_writing": (
        [*_LMPS, *_LOAD[2:]],
        " UNION ALL ".join(
            [
                *(
                    f"SELECT '{t}' AS table_name, 'rows' AS column_name, count(*) AS violations FROM {t}"
                    for t in ("mart_lmps", "mart_load")
                ),
                _nulls("mart_lmps", "hour_beginning_utc", "pnode_id", "total_lmp_da"),
                _nulls("mart_load", "hour_beginning_utc", "zone", "actual_load_mw"),
            ]
        ),
    ),
    "dq_unique": (
        _CHECKED,
        " UNION ALL ".join(
            [
                _repeats("mart_lmps", "hour_beginning_utc", "pnode_id"),
                _repeats("mart_load", "hour_beginning_utc", "zone"),
                _repeats("dim_pnode", "pnode_id"),
                _repeats("dim_calendar", "hour_beginning_ept"),
            ]
        ),
    ),
    "sink_roundtrip": (
        _DA_FEED_ONLY,
        f"SELECT *, CAST(date_trunc('month', {_local('datetime_beginning_ept')}) AS DATE)"
        " AS feed_month FROM da_feed",
    ),
    "sink_two_sources": (_DA_FEED_ONLY, "SELECT * FROM da_feed"),
    "backfill_missing_periods": (
        _DA_FEED_ONLY,
        "SELECT * REPLACE (if(datetime_beginning_ept LIKE '1996-%', 'kept', source) AS source)"
        " FROM da_feed",
    ),
    "stream_upsert": (
        [*_RT_5MIN_ONLY, _STG_5MIN],
        "SELECT *, CAST(hour_beginning_utc AS DATE) AS date_utc FROM stg_5min",
    ),
    "stream_backlog": (
        [*_RT_5MIN_ONLY, _STG_5MIN],
        "SELECT *, CAST(hour_beginning_utc AS DATE) AS date_utc FROM stg_5min",
    ),
}


def all_oracles() -> dict[str, str]:
    return {
        key: "WITH " + ",".join(relations) + "\n" + select
        for key, (relations, select) in _RELATIONS_AND_SELECT.items()
    }
