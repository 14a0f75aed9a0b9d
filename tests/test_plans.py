from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from acceptance import queries
from gridmarts import schemas
from gridmarts.operators.upsert import read_table
from gridmarts.plans import dims, kpi, marts, series, staging, tiers
from gridmarts.sources.feeds import conform, scan_feed
from gridmarts.sources.sinks import write_feed
from gridmarts.streaming.ingest import stream_upsert

DA = "datetime_beginning_ept string, pnode_id string, pnode_name string, type string, zone string, total_lmp_da double"
RT = DA.replace("_da", "_rt")


def da_feed(spark, *rows):
    return spark.createDataFrame(list(rows), DA)


def rt_feed(spark, *rows):
    return spark.createDataFrame(list(rows), RT)


def test_staging_drops_rows_without_price(spark, rows):
    feed = da_feed(
        spark,
        ("1/5/2025 0:00", "51217.0", " HUB ", "HUB", None, 1.5),
        ("1/5/2025 0:00", "50001", "DUQ", "ZONE", " DUQ ", None),
    )
    staged = staging.stage_da(feed)
    assert rows(staged, "hour_beginning_utc", "pnode_id", "pnode_name", "source") == [
        (datetime(2025, 1, 5, 5), 51217, "HUB", "pjm")
    ]


def test_mart_lmps(spark, rows):
    da = da_feed(
        spark,
        ("1/5/2025 0:00", "1", "A", "ZONE", "A", 5.0),
        ("1/5/2025 1:00", "1", "A", "ZONE", "A", 6.0),
        ("1/5/2025 0:00", "N/A", "B", "ZONE", "B", 7.0),
    )
    rt = rt_feed(
        spark,
        ("1/5/2025 0:00", "1", "A", "ZONE", "A", 2.0),
        ("1/5/2025 0:00", "1", "A", "ZONE", "A", 8.0),
        ("1/5/2025 0:00", "N/A", "B", "ZONE", "B", 3.0),
    )
    mart = marts.build_mart_lmps(staging.stage_da(da), staging.stage_rt(rt))
    assert rows(mart, "pnode_name", "total_lmp_da", "total_lmp_rt", "da_rt_spread") == [
        ("A", 5.0, 2.0, 3.0),
        ("A", 5.0, 8.0, -3.0),
        ("A", 6.0, None, None),
        ("B", 7.0, None, None),  # a NULL id matches nothing
    ]


def test_mart_load(spark, rows):
    load = spark.createDataFrame(
        [("1/5/2025 0:00", " duq ", "110"), ("1/5/2025 1:00", "DUQ", "50"), ("1/5/2025 2:00", "DUQ", "7")],
        "datetime_beginning_ept string, zone string, mw string",
    )
    forecast = spark.createDataFrame(
        [
            ("1/4/2025 0:00", "1/5/2025 0:00", "DUQ", 90.0),
            ("1/4/2025 1:00", "1/5/2025 0:00", "DUQ", 100.0),
            ("1/4/2025 0:00", "1/5/2025 1:00", "Duq", 0.0),
        ],
        "evaluated_at_datetime_ept string, forecast_datetime_beginning_ept string, forecast_area string, forecast_load_mw double",
    )
    mart = marts.build_mart_load(staging.stage_load(load), staging.stage_forecast(forecast))
    assert rows(mart, "zone", "actual_load_mw", "forecast_load_mw", "forecast_error_mw", "forecast_error_pct") == [
        ("DUQ", 50.0, 0.0, 50.0, None),
        ("DUQ", 7.0, None, None, None),
        ("duq", 110.0, 100.0, 10.0, 10.0),
    ]


def test_dimensions(spark, rows):
    da = staging.stage_da(
        da_feed(
            spark,
            ("1/6/2025 6:00", "51217", "WESTERN HUB", "HUB", None, 1.0),
            ("1/6/2025 22:00", "50001", "DUQ", "ZONE", "DUQ", 1.0),
            ("1/6/2025 7:00", "7", "X", "LOAD", "X", 1.0),
            ("1/6/2025 7:00", "abc", "Y", "LOAD", "Y", 1.0),
            ("1/6/2025 8:00", "7", "X", "LOAD", "X", 1.0),
        )
    )
    assert rows(dims.build_dim_pnode(da), "pnode_id", "display_name", "pnode_group") == [
        (50001, "DUQ Zone", "Zone"),
        (51217, "Western Hub", "Hub"),
        (7, "X", "Other"),
    ]
    calendar = {r.hour_of_day: r for r in dims.build_dim_calendar(da).collect()}
    assert sorted(calendar) == list(range(6, 23))
    assert calendar[6].is_peak and calendar[21].is_peak and not calendar[22].is_peak
    assert (calendar[6].day_name, calendar[6].month_name, calendar[6].day_of_week) == ("Monday", "January", 1)
    assert dims.build_dim_calendar(da.filter("false")).count() == 0


def test_weekend_is_off_peak_and_days_have_24_rows(spark):
    spring = da_feed(spark, ("3/9/2024 0:00", "1", "A", "ZONE", "A", 1.0), ("3/10/2024 23:00", "1", "A", "ZONE", "A", 1.0))
    calendar = dims.build_dim_calendar(staging.stage_da(spring))
    assert calendar.count() == 48
    assert calendar.filter("is_peak").count() == 0


def test_versions_of_a_forecast_are_reduced_before_times_are_parsed(spark, rows):
    """Several texts of one hour and of one time of issue; the latest, then greatest, counts."""
    feed = spark.createDataFrame(
        [
            ("1/4/2025 1:00", "1/6/2025 0:00", " DUQ", 4.0),
            ("2025-01-04 01:00:00", "01/06/2025 00:00", "DUQ ", 6.0),
            ("1/4/2025 1:00", "1/6/2025 0:00", "DUQ", None),
            ("1/3/2025 23:00", "2025-01-06 05:00:00", "DUQ", 9.0),
            (None, "1/6/2025 0:00", "DUQ", 10.0),
            ("1/4/2025 1:00", "1/6/2025 0:00", None, 2.0),
            ("1/4/2025 1:00", "1/6/2025 0:00", None, 3.0),
            (None, None, "AEP", None),
        ],
        "evaluated_at_datetime_ept string, forecast_datetime_beginning_ept string, forecast_area string, forecast_load_mw double",
    )
    found = staging.stage_forecast(feed)
    assert rows(found, "forecast_area", "forecast_load_mw", "evaluated_at_ept") == [
        ("AEP", None, None), ("DUQ", 6.0, datetime(2025, 1, 4, 1)), (None, 3.0, datetime(2025, 1, 4, 1)),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3  # by all texts, by hour and area as texts, by hour and area


def test_a_figure_builds_the_tiers_of_its_own_fact_only(spark, monkeypatch):
    built = []
    stored = queries.stored_fact
    monkeypatch.setattr(queries, "stored_fact", lambda s, d, name: built.append(name) or stored(s, d, name))
    monkeypatch.setattr(queries, "_stored", {})
    queries.freshness(spark, "/root/testdata/sf0.001")
    assert built == ["mart_lmps"]
    queries.kpi_load(spark, "/root/testdata/sf0.001")
    assert built == ["mart_lmps", "mart_load"]


def test_refresh_with_lookback(spark, rows, tmp_path):
    path = str(tmp_path / "mart")
    hours = [("1/5/2025 0:00", 1.0), ("1/5/2025 1:00", 2.0), ("1/6/2025 0:00", 3.0)]
    da = da_feed(spark, *[(t, "1", "A", "ZONE", "A", p) for t, p in hours])
    rt = rt_feed(spark, *[(t, "1", "A", "ZONE", "A", p + 0.5) for t, p in hours])
    early = F.col("datetime_beginning_ept").startswith("1/5/")
    marts.refresh_mart_lmps(spark, path, da.filter(early), rt.filter("false"))
    marts.refresh_mart_lmps(spark, path, da, rt)
    # the late real-time prices of stored hours stay missing without a lookback
    assert rows(read_table(spark, path), "total_lmp_da", "total_lmp_rt") == [(1.0, None), (2.0, None), (3.0, 3.5)]
    marts.refresh_mart_lmps(spark, path, da, rt, lookback_hours=48)
    assert rows(read_table(spark, path), "total_lmp_da", "total_lmp_rt") == [(1.0, 1.5), (2.0, 2.5), (3.0, 3.5)]


def test_refresh_gives_what_a_full_build_gives(spark, rows, tmp_path):
    """The skipped hour of spring and the next are one instant: both rows stay, in whichever run they come."""
    hours = [("3/9/2025 0:00", 1.0), ("3/10/2024 2:00", 2.0), ("3/10/2024 3:00", 3.0)]
    da = da_feed(spark, *[(t, "1", "A", "ZONE", "A", p) for t, p in hours])
    rt = rt_feed(spark, *[(t, "1", "A", "ZONE", "A", p + 0.5) for t, p in hours[:2]])
    whole = marts.build_mart_lmps(staging.stage_da(da), staging.stage_rt(rt))
    assert whole.count() == 3
    for early in ("false", "datetime_beginning_ept = '3/10/2024 2:00'", "true"):
        path = str(tmp_path / f"mart{len(early)}")
        marts.refresh_mart_lmps(spark, path, da.filter(early), rt.filter(early))
        for _ in range(2):
            marts.refresh_mart_lmps(spark, path, da, rt, lookback_hours=24 * 400)
            assert rows(read_table(spark, path).drop("date_utc")) == rows(whole)


def test_refresh_of_load(spark, rows, tmp_path):
    path = str(tmp_path / "mart")
    load = spark.createDataFrame(
        [("1/5/2025 0:00", "DUQ", "1"), ("1/6/2025 0:00", "DUQ", "2")],
        "datetime_beginning_ept string, zone string, mw string",
    )
    forecast = spark.createDataFrame(
        [("1/4/2025 0:00", "1/6/2025 0:00", "DUQ", 4.0)],
        "evaluated_at_datetime_ept string, forecast_datetime_beginning_ept string, forecast_area string, forecast_load_mw double",
    )
    marts.refresh_mart_load(spark, path, load.filter("mw = 1"), forecast, unit="month")
    marts.refresh_mart_load(spark, path, load, forecast, unit="month")
    assert rows(read_table(spark, path), "actual_load_mw", "forecast_load_mw") == [(1.0, None), (2.0, 4.0)]


def test_refresh_opens_new_folders_only(spark, tmp_path):
    feed = da_feed(spark, *[(f"{m}/5/2025 0:00", "1", "A", "ZONE", "A", 1.0) for m in range(1, 7)])
    write_feed(feed, str(tmp_path / "feed"))
    landed = scan_feed(spark, str(tmp_path / "feed"), "da_lmps")
    stored = staging.stage_da(feed.filter("datetime_beginning_ept < '5'"))
    new = marts._new_feed(landed, stored, staging.stage_da, "hour_beginning_utc", 24)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = new._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(feed_date" in plan and "2025-04-03" in plan
    assert new.count() == 3  # April on, with the day of lookback


def test_building_a_plan_starts_no_job(spark, tmp_path):
    da = da_feed(spark, ("1/5/2025 0:00", "1", "A", "ZONE", "A", 1.0))
    rt = rt_feed(spark, ("1/5/2025 0:00", "1", "A", "ZONE", "A", 2.0))
    da, rt = staging.stage_da(da), staging.stage_rt(rt)
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        marts.build_mart_lmps(da, rt)
        as_of = datetime(2025, 1, 6)
        empty = conform(rt_feed(spark), schemas.RT_FEED), conform(da_feed(spark), schemas.DA_FEED)
        recent = tiers.recent_rt(empty[0], as_of), tiers.recent_da(empty[1], as_of)
        series.join_recent(*recent)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_series_are_whole_and_skip_folders(spark, tmp_path):
    hours = 6_000
    mart = spark.range(hours).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as hour_beginning_utc", "'DUQ' as zone",
        "1.0D as actual_load_mw", "1.0D as forecast_load_mw", "0.0D as forecast_error_pct",
        "2 as pnode_id", "'DUQ' as pnode_name", "1.0D as total_lmp_da", "1.0D as total_lmp_rt", "0.0D as da_rt_spread",
    )
    tiers.write_tiers(str(tmp_path), mart_lmps=mart, mart_load=mart)
    stored = series.read_tiers(spark, str(tmp_path))
    prices = series.lmp_series(stored, "2024-01-01", "2025-01-01", series.DUQ, grain="hourly")
    assert kpi.freshness(prices).first()["row_count"] == hours
    loads = series.load_series(stored, "2024-02-01", "2024-03-31", zone="DUQ")
    assert loads.count() == 60 * 24
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = loads._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(month_utc" in plan


def test_recent_tiers(spark, rows):
    feed = rt_feed(
        spark,
        ("1/1/2025 0:00", "1", " A ", "ZONE", None, 1.0),
        ("1/5/2025 0:05", "oops", "B", "ZONE", " Z ", 2.0),
        ("2025-01-05 00:00:00", "1", "C", "ZONE", "Z", 3.0),
    )
    feed = feed.withColumns({"congestion_price_rt": F.lit("0.5"), "marginal_loss_price_rt": F.lit("x")})
    kept = tiers.recent_rt(feed, datetime(2025, 1, 8))
    assert rows(kept, "pnode_id", "pnode_name", "zone", "congestion_rt", "loss_rt") == [
        (1, "A", "A", 0.5, None),
        (None, "B", "Z", 0.5, None),
    ]
    assert tiers.recent_rt(feed, datetime(2025, 1, 8, 0, 1)).count() == 1


def mart(spark, *rows):
    """Rows of (utc hour text, node, zone, da, rt)."""
    df = spark.createDataFrame(list(rows), "t string, pnode_id int, zone string, total_lmp_da double, total_lmp_rt double")
    return df.select(
        F.col("t").cast("timestamp_ntz").alias("hour_beginning_utc"),
        "pnode_id",
        F.col("zone").alias("pnode_name"),
        "zone",
        "total_lmp_da",
        "total_lmp_rt",
        (F.col("total_lmp_da") - F.col("total_lmp_rt")).alias("da_rt_spread"),
    )


def test_daily_tier_and_day_zone(spark, rows):
    prices = mart(spark, ("2025-01-05 03:00", 1, "A", 1.0, None), ("2025-01-05 06:00", 1, "A", 4.0, 2.0))
    assert rows(tiers.lmp_daily(prices), "date_utc", "avg_lmp_da", "avg_lmp_rt", "min_lmp_da", "max_lmp_da", "hours") == [
        (date(2025, 1, 5), 2.5, 2.0, 1.0, 4.0, 2)
    ]
    local = tiers.lmp_daily(prices, day_zone="America/New_York")
    assert rows(local, "date_utc", "hours") == [(date(2025, 1, 4), 1), (date(2025, 1, 5), 1)]


def test_grain_routing():
    day = date(2025, 1, 1)
    spans = {0: "intraday", 7: "intraday", 8: "hourly", 186: "hourly", 187: "daily"}
    for span, grain in spans.items():
        assert series.grain_for(day, date.fromordinal(day.toordinal() + span)) == grain


def test_hourly_series_averages_nodes_and_prunes_halves(spark, rows, tmp_path):
    prices = mart(
        spark,
        ("2025-06-30 22:00", 50001, "DUQ", 1.0, 1.0),
        ("2025-06-30 22:00", 50009, "DUQ", 3.0, None),
        ("2025-07-10 00:00", 50001, "DUQ", 5.0, 6.0),
        ("2025-07-10 00:00", 51217, "DUQ", 99.0, 99.0),
        ("2025-07-10 00:00", None, "DUQ", 77.0, 77.0),
        ("2025-07-16 00:00", 50001, "DUQ", 9.0, 9.0),
        ("2024-07-10 00:00", 50001, "DUQ", 9.0, 9.0),
    )
    path = str(tmp_path / "tiers")
    tiers.write_tiers(path, mart_lmps=prices)
    stored = series.read_tiers(spark, path)
    got = series.lmp_series(stored, "2025-06-30", "2025-07-15", series.DUQ)
    assert [tuple(r) for r in got.collect()] == [
        (datetime(2025, 6, 30, 22), 2.0, 1.0, 0.0),
        (datetime(2025, 7, 10), 5.0, 6.0, -1.0),
    ]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    got = series.lmp_series(stored, "2025-06-30", "2025-07-15", series.DUQ)
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [half" in plan
    assert "GreaterThanOrEqual(hour_beginning_utc" in plan
    hub = series.lmp_series(stored, "2025-06-30", "2025-07-15", series.WESTERN_HUB)
    assert rows(hub, "da") == [(99.0,)]
    daily = series.lmp_series(stored, "2024-01-01", "2025-12-31", series.DUQ, limit=2)
    assert rows(daily, "ts") == [(datetime(2024, 7, 10),), (datetime(2025, 6, 30),)]
    with pytest.raises(ValueError, match="rt_recent or da_recent"):
        series.lmp_series(stored, "2025-07-01", "2025-07-02", series.DUQ)


def test_intraday_series(spark, rows):
    as_of = datetime(2025, 1, 6)
    rt = [("1/5/2025 0:00", 2.0), ("1/5/2025 0:05", 3.0), ("12/31/2024 0:00", 4.0)]
    rt = rt_feed(spark, *[(t, "50001", "DUQ", "ZONE", "DUQ", p) for t, p in rt])
    da = da_feed(spark, ("01/05/2025 00:00", "50001", "DUQ", "ZONE", "DUQ", 5.0))
    nothing = {f"{c}_rt": F.lit(None).cast("double") for c in ("congestion_price", "marginal_loss_price")}
    stored = series.Tiers(
        rt_recent=tiers.recent_rt(rt.withColumns(nothing), as_of), da_recent=tiers.recent_da(da, as_of)
    )
    got = series.lmp_series(stored, "2025-01-01", "2025-01-06", series.DUQ)
    assert [tuple(r) for r in got.collect()] == [
        (datetime(2025, 1, 5), 5.0, 2.0, 3.0),
        (datetime(2025, 1, 5, 0, 5), None, 3.0, None),
    ]


def test_figures(spark, rows):
    prices = spark.createDataFrame([(1, 2.0, None, None), (2, 4.0, 1.0, 3.0)], "ts int, da double, rt double, spread double")
    assert rows(kpi.kpi_prices(prices)) == [(3.0, 1.0, 3.0)]
    assert rows(kpi.freshness(prices)) == [(2, 2)]
    assert rows(kpi.with_spread_sign(prices), "sign") == [("na",), ("pos",)]
    load = spark.createDataFrame(
        [(100.0, 90.0, None), (0.0, 5.0, -3.0), (50.0, None, -1.0)], "actual double, forecast double, peak double"
    )
    assert rows(kpi.kpi_load(load)) == [(0.0, 10.0)]
    assert rows(kpi.kpi_load(load.filter("false"))) == [(None, None)]


def test_load_series(spark, rows):
    hourly = spark.createDataFrame(
        [("2025-01-05 00:00", "DUQ", 1.0, 2.0), ("2025-01-05 00:00", "AEP", 3.0, 4.0)],
        "t string, zone string, actual_load_mw double, forecast_load_mw double",
    ).withColumn("hour_beginning_utc", F.col("t").cast("timestamp_ntz"))
    stored = series.Tiers(mart_load=hourly)
    assert rows(series.load_series(stored, "2025-01-01", "2025-01-31")) == [(datetime(2025, 1, 5), 1.0, 2.0, 1.0)]
    with pytest.raises(ValueError, match="load_daily"):
        series.load_series(stored, "2024-01-01", "2025-01-31")


def test_stream_takes_new_files_only_and_later_files_win(spark, rows, tmp_path):
    landed, target, mark = (str(tmp_path / n) for n in ("landed", "target", "mark"))

    def land(*prices):
        feed = rt_feed(spark, *[(t, "1", "A", "ZONE", "A", p) for t, p in prices])
        feed.write.mode("append").parquet(landed)
        stream_upsert(spark, landed, schemas.RT_FEED, staging.stage_rt, target, schemas.MART_LMPS_KEY, "hour_beginning_utc", mark)

    land(("1/5/2025 0:00", 1.0), ("1/5/2025 1:00", 2.0))
    land(("1/5/2025 1:00", 20.0), ("1/6/2025 1:00", 3.0))
    land()
    assert rows(read_table(spark, target), "total_lmp_rt") == [(1.0,), (20.0,), (3.0,)]


def test_ranges_of_the_duration_curve_follow_the_data(spark, monkeypatch):
    asked = []
    ranked = kpi.rank_descending
    monkeypatch.setattr(kpi, "rank_descending", lambda df, value, buckets=None, **more: asked.append(buckets) or ranked(df, value, buckets, **more))
    prices = spark.createDataFrame([(float(i),) for i in range(5)], "da double")
    got = kpi.duration_curve(prices).collect()
    assert asked == [None] and sorted(r["price"] for r in got) == [0.0, 1.0, 2.0, 3.0, 4.0]
