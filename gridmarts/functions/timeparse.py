"""Wall-clock text to timestamps.

All results are TIMESTAMP_NTZ, so nothing here depends on the session time zone:
``*_ept`` columns hold the local wall clock, ``*_utc`` columns the same instant
written in UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MARKET_ZONE = "America/New_York"

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}

# month/day/year hour:minute, one or two digits each, blanks around it allowed
US_STYLE = r"^ *(\d{1,2})/(\d{1,2})/(\d{4}) +(\d{1,2}):(\d{1,2}) *$"

# an ISO text that names its own offset ("...05:00Z", "...05:00:00-05:00")
_HAS_OFFSET = r":\d{1,2}(\.\d+)? *([Zz]|[+-]\d{1,2}(:?\d{2})?) *$"


def naive(moment: datetime) -> Column:
    """A literal clock reading. By way of text, since a datetime literal is an instant."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _is_us_style(text: Column) -> Column:
    # No ISO text holds a slash, so this is a cheap stand-in for the full pattern.
    return F.instr(text, "/") > 0


def wall_clock(text: Column, strict: bool = True) -> Column:
    """Read US-style or ISO text as a naive timestamp.

    US-style text is rewritten to ISO and any other text is left as it is, so one
    cast serves both and no row pays for a failed parse. With ``strict`` the cast
    raises on unreadable text (ANSI mode); without it such text becomes NULL.
    """
    iso = F.regexp_replace(text, US_STYLE, "$3-$1-$2 $4:$5")
    return iso.cast("timestamp_ntz") if strict else iso.try_cast("timestamp_ntz")


def us_wall_clock(text: Column) -> Column:
    """Read US-style text only; anything else is NULL."""
    return F.when(_is_us_style(text), wall_clock(text, strict=False))


def _shift_to_utc(local: Column, zone: str) -> Column:
    session_zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
    if session_zone in _UTC_NAMES:
        # Several times faster: the zone is looked up once, not per row. The casts keep
        # the clock reading only because the session runs on UTC.
        return F.to_utc_timestamp(local.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def local_to_utc(local: Column, zone: str = MARKET_ZONE) -> Column:
    """Naive local time to naive UTC, for zones whose clocks change by one hour.

    Spark takes the earlier instant of a repeated autumn hour; the later one is wanted.
    The hour after it is not repeated, so its instant less one hour is the later one.
    In a skipped spring hour that detour is an hour early, and everywhere else it
    changes nothing: the greater of the two is right in every case.
    """
    hour = F.expr("interval 1 hour")
    return F.greatest(_shift_to_utc(local, zone), _shift_to_utc(local + hour, zone) - hour)


def _instant_to_utc(text: Column) -> Column:
    micros = F.unix_micros(text.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def to_utc(text: Column, local: Column, iso_zone: str = "UTC") -> Column:
    """UTC time of a row, given its text and the wall clock already read from it.

    US-style text is market time. ISO text uses its own offset if it has one and is
    otherwise taken to be in ``iso_zone``.
    """
    plain = local if iso_zone == "UTC" else local_to_utc(local, iso_zone)
    return (
        F.when(_is_us_style(text), local_to_utc(local))
        .when(text.rlike(_HAS_OFFSET), _instant_to_utc(text))
        .otherwise(plain)
    )
