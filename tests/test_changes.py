"""What is kept up to date by what has landed, and tables of the catalog."""

import json
import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from acceptance import queries
from gridmarts import schemas
from gridmarts.operators.quality import observed
from gridmarts.operators.ranking import rank_descending
from gridmarts.operators.upsert import read_table
from gridmarts.plans import changes, series, tiers
from gridmarts.plans.marts import HOUR
from gridmarts.sources import catalog, sinks
from gridmarts.sources.pages import unwrap_pages

SMALL = "/root/testdata/sf0.001"


def price(side, when, node, value):
    return (when, node, f"node {node}", "ZONE", f"zone {node}", value)


def prices(spark, side, rows):
    names = "datetime_beginning_ept string, pnode_id string, pnode_name string, type string, zone string"
    return spark.createDataFrame([price(side, *r) for r in rows], f"{names}, total_lmp_{side} double")


def files_below(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_right_side_a_month_late(spark, rows, tmp_path):
    da, rt, fact, daily = (str(tmp_path / n) for n in ("da", "rt", "fact", "daily"))
    hours = [("3/1/2024 10:00", "1", 10.0), ("3/1/2024 11:00", "1", 11.0), ("3/20/2024 10:00", "2", 12.0), ("3/20/2024 10:00", "N/A", 13.0)]
    sinks.write_feed(prices(spark, "da", hours), da)
    sinks.write_feed(prices(spark, "rt", [("3/20/2024 10:00", "2", 2.0)]), rt)
    seen = []

    def refresh():
        seen.clear()
        changes.refresh_changed_lmps(spark, fact, da, rt, str(tmp_path / "checkpoint"), touched=seen.extend)

    refresh()
    changes.refresh_daily(spark, fact, daily)
    found = ["pnode_name", "total_lmp_da", "total_lmp_rt"]
    assert rows(read_table(spark, fact), *found) == [
        ("node 1", 10.0, None), ("node 1", 11.0, None), ("node 2", 12.0, 2.0), ("node N/A", 13.0, None),
    ]
    before = files_below(fact)
    refresh()  # nothing has landed
    assert seen == [] and files_below(fact) == before

    sinks.write_feed(prices(spark, "rt", [("3/1/2024 11:00", "1", 1.0)]), rt, part="late")
    refresh()
    assert seen == [date(2024, 3, 1)]
    assert rows(read_table(spark, fact), *found)[1] == ("node 1", 11.0, 1.0)
    after = files_below(fact)
    kept = {p for p in before if "date_utc=2024-03-20" in p}
    assert kept and all(after[p] == before[p] for p in kept)  # the other day's files are those of before
    changes.refresh_daily(spark, fact, daily, seen)
    anew = tiers.lmp_daily(read_table(spark, fact).drop("date_utc"))
    assert rows(changes.read_daily(spark, daily)) == rows(anew)


def test_only_touched_folders_of_a_feed_are_read(spark, tmp_path):
    path = str(tmp_path / "da")
    sinks.write_feed(prices(spark, "da", [("3/1/2024 10:00", "1", 1.0), ("4/9/2024 10:00", "1", 1.0)]), path)
    feed = changes.in_days(spark.read.parquet(path), [date(2024, 4, 9)])
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed_date" in plan and len(feed.inputFiles()) >= 1
    assert feed.count() == 1


def test_partials_fold_into_those_of_the_whole(spark, rows):
    mart = queries._mart_lmps(spark, SMALL)
    part = F.pmod(F.xxhash64(HOUR, "pnode_name"), F.lit(3))
    parts = [changes.lmp_partials(mart.filter(part == i)) for i in range(3)]
    folded = changes.fold(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(folded) == rows(changes.lmp_partials(mart).select(folded.columns))


def test_catalog_answers_without_files(spark, rows, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    stored = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, "é/=+%")], "x int, part string")
    catalog.save_table(stored, name, "part", str(tmp_path / name))
    listed = catalog.periods(spark, name, "part")
    assert rows(listed) == [("a b",), ("é/=+%",), (None,)]
    for df in (listed, catalog.extent(spark, name, "part")):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    batch = spark.createDataFrame([(9, "a b"), (9, None), (5, "new"), (6, "new")], "x int, part string")
    catalog.add_missing_periods(batch, name, "part")
    assert rows(spark.table(name)) == [(1, "a b"), (2, "a b"), (3, None), (4, "é/=+%"), (5, "new"), (6, "new")]
    assert catalog.high_mark(spark, name, "part", "x") == 4
    plan = catalog.newest_rows(spark, name, "part")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    late = catalog.rows_after_mark(
        spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp_ntz"), _hours(spark, tmp_path), "d", "t", 5
    )
    assert late.count() == 1
    empty = f"t_{uuid.uuid4().hex}"
    catalog.save_table(stored.limit(0), empty, "part", str(tmp_path / empty))
    assert rows(catalog.extent(spark, empty, "part")) == [(None, None)]
    assert catalog.high_mark(spark, empty, "part", "x") is None and catalog.rows_after_mark(batch, empty, "part", "x") is batch


def _hours(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 4), date(2024, 1, 1))], "t timestamp_ntz, d date")
    catalog.save_table(rows, name, "d", str(tmp_path / name))
    return name


def test_bucketed_sides_join_without_a_shuffle(spark):
    plan = queries.mart_lmps_bucketed(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_every_element_of_a_page_is_a_row(spark, rows, tmp_path):
    page = [{"pnode_id": 7, "total_lmp_da": 1.25}, {"other": 5}, {"total_lmp_da": None}, None, 3]
    (tmp_path / "page.json").write_text(json.dumps(page))
    found = unwrap_pages(spark, str(tmp_path), "da_lmps", element="element")
    assert rows(found, "pnode_id", "total_lmp_da") == [("7", 1.25)] + [(None, None)] * 4
    assert rows(found.select(F.try_variant_get("element", "$.other", "int").alias("other")).dropna()) == [(5,)]
    (tmp_path / "broken.json").write_text('[{"pnode_id": 1')
    (tmp_path / "blank.json").write_text("\n ")
    whole = unwrap_pages(spark, str(tmp_path / "*.json"), "da_lmps", rejected=str(tmp_path / "rejected"))
    assert whole.schema == schemas.DA_FEED and whole.count() == 5
    bad = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["page"]) for r in bad] == [("broken.json", '[{"pnode_id": 1')]


@pytest.mark.parametrize("buckets", [1, 3])
def test_positions_within_groups(spark, buckets):
    data = [("a", 1.0)] * 5 + [("a", float(i % 7)) for i in range(40)] + [("b", 2.0), (None, 3.0), (None, 9.0), ("b", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = sorted(tuple(r) for r in rank_descending(df, "v", buckets, rows_per_chunk=3, by=("g",)).na.fill({"g": "-"}).collect())
    want = []
    for g in ("a", "b", None):
        values = sorted((v for k, v in data if k == g and v is not None), reverse=True)
        want += [(g or "-", i, v, len(values)) for i, v in enumerate(values)]
    assert got == sorted(want)


def test_which_tier_serves_which_days(spark):
    recent = spark.createDataFrame([("1/10/2024 23:55",), ("1/14/2024 1:00",)], "datetime_beginning_ept string")
    some = spark.range(1).toDF("x")
    full = series.Tiers(rt_recent=recent, da_recent=recent, lmps=some, lmps_daily=some)
    day = lambda d: date(2024, 1, d)
    assert series.pieces(full, day(11), day(13)) == [("intraday", day(11), day(13))]
    assert series.pieces(full, day(9), day(13)) == [("hourly", day(9), day(10)), ("intraday", day(11), day(13))]
    assert series.pieces(full, day(1), day(5)) == [("hourly", day(1), day(5))]
    bare = series.Tiers(lmps=some)
    assert series.pieces(bare, day(9), day(13)) == [("hourly", day(9), day(13))]
    assert series.pieces(bare, date(2020, 1, 1), day(13)) == [("hourly", date(2020, 1, 1), day(13))]
    assert series.pieces(series.Tiers(lmps_daily=some), day(1), day(20)) == [("daily", day(1), day(20))]


def test_counts_come_with_the_write(spark, tmp_path):
    df, seen = observed(spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string"), ["a", "b"])
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 3, "a": 1, "b": 2}
