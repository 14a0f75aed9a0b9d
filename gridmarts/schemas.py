"""Landed feed schemas and the fixed values of the market data."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values. They must equal what the data and its users already use.
WESTERN_HUB_ID = 51217
WESTERN_HUB_LABEL = "Western Hub"
HOME_ZONE = "DUQ"
HOME_ZONE_LABEL = "DUQ Zone"
API_SOURCE = "pjm"
BACKFILL_SOURCE = "eia"
ZONE_TYPE = "ZONE"
HUB_TYPE = "HUB"
GROUP_OF_TYPE = {"HUB": "Hub", "ZONE": "Zone"}
OTHER_GROUP = "Other"

_STRING, _DOUBLE = T.StringType(), T.DoubleType()


def _schema(text: str, numbers: str) -> T.StructType:
    fields = [T.StructField(c, _STRING) for c in text.split()]
    fields += [T.StructField(c, _DOUBLE) for c in numbers.split()]
    return T.StructType(fields)


_PRICE_TEXT = "datetime_beginning_ept pnode_id pnode_name type pnode_type zone source"

DA_FEED = _schema(
    _PRICE_TEXT,
    "system_energy_price_da congestion_price_da marginal_loss_price_da total_lmp_da",
)
RT_FEED = _schema(
    _PRICE_TEXT,
    "system_energy_price_rt congestion_price_rt marginal_loss_price_rt total_lmp_rt",
)
LOAD_FEED = _schema(
    "datetime_beginning_ept zone load_area nerc_region mkt_region is_verified", "mw"
)
FORECAST_FEED = _schema(
    "evaluated_at_datetime_ept forecast_datetime_beginning_ept forecast_area",
    "forecast_load_mw",
)

FEEDS = {
    "da_lmps": DA_FEED,
    "rt_lmps": RT_FEED,
    "rt_5min": RT_FEED,
    "load": LOAD_FEED,
    "load_forecast": FORECAST_FEED,
}

MART_LMPS_KEY = ["hour_beginning_utc", "pnode_id"]
MART_LOAD_KEY = ["hour_beginning_utc", "zone"]
