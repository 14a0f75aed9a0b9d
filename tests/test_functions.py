import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridmarts.functions.casts import lenient_int, to_bool, to_double
from gridmarts.functions.labels import half_year, halves_between, parse_day, spread_sign
from gridmarts.functions.means import exact_mean
from gridmarts.functions.timeparse import local_to_utc, to_utc, us_wall_clock, wall_clock


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("text", ["1/5/2025 0:00", "01/05/2025 00:00", " 1/5/2025 0:00", "2025-01-05"])
def test_readable_times(spark, text):
    assert one(spark, text, "string", wall_clock) == datetime(2025, 1, 5)


@pytest.mark.parametrize("text", ["1/5/2025 0:00:00", "13/1/2025 0:00", "1/5/25 0:00", "soon", ""])
def test_unreadable_times(spark, text):
    assert one(spark, text, "string", lambda c: wall_clock(c, strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, text, "string", wall_clock)


def test_us_style_only(spark):
    assert one(spark, "2025-01-05 00:00:00", "string", us_wall_clock) is None
    assert one(spark, "1/5/2025 3:05", "string", us_wall_clock) == datetime(2025, 1, 5, 3, 5)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize(
    ("local", "utc"),
    [
        ("2025-07-01 00:00", "2025-07-01 04:00"),
        ("2025-01-05 00:00", "2025-01-05 05:00"),
        ("2024-11-03 00:30", "2024-11-03 04:30"),
        ("2024-11-03 01:00", "2024-11-03 06:00"),  # repeated hour: the later instant
        ("2024-11-03 02:00", "2024-11-03 07:00"),
        ("2024-03-10 01:59", "2024-03-10 06:59"),
        ("2024-03-10 02:00", "2024-03-10 07:00"),  # skipped hour
        ("2024-03-10 03:00", "2024-03-10 07:00"),
    ],
)
def test_local_to_utc_in_any_session_zone(spark, zone, local, utc):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, local, "string", lambda c: local_to_utc(c.cast("timestamp_ntz")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == datetime.fromisoformat(utc)


@pytest.mark.parametrize(
    ("text", "iso_zone", "utc"),
    [
        ("1/5/2025 0:00", "UTC", "2025-01-05 05:00"),
        ("2025-01-05 00:00:00", "UTC", "2025-01-05 00:00"),
        ("2025-01-05 00:00:00", "America/New_York", "2025-01-05 05:00"),
        ("2025-01-05T00:00:00-05:00", "UTC", "2025-01-05 05:00"),
        ("2025-01-05T00:00:00Z", "America/New_York", "2025-01-05 00:00"),
    ],
)
def test_utc_of_a_row(spark, text, iso_zone, utc):
    got = one(spark, text, "string", lambda c: to_utc(c, wall_clock(c), iso_zone))
    assert got == datetime.fromisoformat(utc)


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        ("12.5", "string", 13),
        ("13.5", "string", 14),
        ("51217.0", "string", 51217),
        ("1e3", "string", 1000),
        (" 7 ", "string", 7),
        ("abc", "string", None),
        ("", "string", None),
        ("NaN", "string", None),
        ("99999999999", "string", None),
        (2.5, "double", 2),
        (3.5, "double", 4),
        (51217, "bigint", 51217),
        (99999999999, "bigint", None),
    ],
)
def test_lenient_int(spark, value, kind, expected):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    assert df.select(lenient_int(df, "x")).first()[0] == expected


@pytest.mark.parametrize(("text", "expected"), [("true", True), ("T", True), ("1", True), ("yes", True), ("on", None)])
def test_booleans(spark, text, expected):
    assert one(spark, text, "string", to_bool) is expected


@pytest.mark.parametrize(("text", "expected"), [("1e3", 1000.0), ("1,000", None), (" 2 ", 2.0), ("", None)])
def test_doubles(spark, text, expected):
    assert one(spark, text, "string", to_double) == expected


def test_halves(spark):
    assert one(spark, "2024-06-30 23:00", "string", lambda c: half_year(c.cast("timestamp_ntz"))) == "2024H1"
    assert one(spark, "2024-07-01 00:00", "string", lambda c: half_year(c.cast("timestamp_ntz"))) == "2024H2"
    # a range that ends early in a half still touches it
    assert halves_between(date(2024, 6, 30), date(2024, 7, 15)) == ["2024H1", "2024H2"]
    assert halves_between(date(2023, 12, 1), date(2025, 1, 1)) == ["2023H2", "2024H1", "2024H2", "2025H1"]


@pytest.mark.parametrize(("spread", "sign"), [(0.0, "pos"), (-0.1, "neg"), (None, "na")])
def test_spread_sign(spark, spread, sign):
    assert one(spark, spread, "double", spread_sign) == sign


def test_days():
    today = date(2025, 3, 1)
    assert parse_day("yesterday", today) == date(2025, 2, 28)
    assert parse_day("Today", today) == today
    assert parse_day("2024-02-29") == date(2024, 2, 29)


def test_exact_mean_ignores_order_and_nulls(spark):
    values = [0.1] * 7 + [1e9, -1e9, None]
    forward = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    backward = spark.createDataFrame([(v,) for v in reversed(values)], "x double").coalesce(1)
    means = {df.select(exact_mean()(F.col("x"))).first()[0] for df in (forward, backward)}
    assert means == {0.7 / 9}
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.select(exact_mean()(F.col("x"))).first()[0] is None
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert math.isnan(odd.select(exact_mean()(F.col("x"))).first()[0])
