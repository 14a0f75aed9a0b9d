"""A recent tier that is moved along, against one built anew."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from gridmarts.plans import rolling, tiers
from gridmarts.sources import sinks
from gridmarts.sources.feeds import scan_feed

COLUMNS = "datetime_beginning_ept string, pnode_id string, pnode_name string, type string, zone string, total_lmp_rt double"


def land(spark, path, part, rows):
    rows = [(when, node, f" node {node}", "ZONE", None, value) for when, node, value in rows]
    sinks.write_feed(spark.createDataFrame(rows, COLUMNS), path, part=part)


def files_below(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def folders(path):
    return sorted(f.partition("=")[2] for f in os.listdir(path) if f.startswith("feed_date="))


def test_moved_along_equals_built_anew(spark, tmp_path):
    feed, path, checkpoint = (str(tmp_path / n) for n in ("feed", "tier", "checkpoint"))

    def move(as_of, days=2):
        rolling.refresh_recent(spark, path, "rt_lmps", feed, checkpoint, tiers.recent_rt, as_of, days)
        moved = rolling.read_recent(spark, path, as_of, days)
        anew = tiers.recent_rt(scan_feed(spark, feed, "rt_lmps"), as_of, days)
        assert moved.columns == anew.columns
        assert sorted(moved.collect(), key=str) == sorted(anew.collect(), key=str)
        return moved.count()

    land(spark, feed, "a", [("3/1/2024 9:00", "1", 1.0), ("3/4/2024 9:00", "1", 2.0), ("3/4/2024 11:00", "N/A", 3.0), ("3/6/2024 10:00", "1", 4.0)])
    land(spark, feed, "odd", [(None, "1", 9.0), ("2024-03-06 10:00:00", "1", 9.0)])
    assert move(datetime(2024, 3, 6, 10)) == 2  # the day of the first hour is stored whole, and cut on reading
    assert folders(path) == ["2024-03-04", "2024-03-06"]

    before = files_below(path)
    assert move(datetime(2024, 3, 6, 10)) == 2  # nothing has landed
    assert files_below(path) == before

    # a late file of a stored day, a new day, and one of a day that is too old
    land(spark, feed, "b", [("3/6/2024 8:00", "2", 5.0), ("3/7/2024 8:00", "1", 6.0), ("3/2/2024 8:00", "1", 7.0)])
    kept = [f for f in before if "2024-03-04" in f]
    assert move(datetime(2024, 3, 6, 11)) == 4
    assert folders(path) == ["2024-03-04", "2024-03-06", "2024-03-07"]
    assert all(files_below(path)[f] == before[f] for f in kept)

    # the window moves on: nothing lands, a day goes, no file of the others is written
    before = files_below(path)
    assert move(datetime(2024, 3, 8, 8)) == 3
    assert folders(path) == ["2024-03-06", "2024-03-07"]
    assert files_below(path) == {f: t for f, t in before.items() if "2024-03-04" not in f}

    # a rerun of a part brings a day anew, repeated rows included
    land(spark, feed, "b", [("3/7/2024 8:00", "1", 8.0), ("3/7/2024 8:00", "1", 8.0)])
    assert move(datetime(2024, 3, 8, 9)) == 3

    rolling.refresh_recent(spark, path, "rt_lmps", feed, checkpoint, tiers.recent_rt, datetime(2024, 5, 1), 2)
    assert folders(path) == [] and rolling.read_recent(spark, path, datetime(2024, 5, 1), 2) is None


def test_a_feed_of_older_days_only(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "tier")
    land(spark, feed, "a", [("3/1/2024 9:00", "1", 1.0)])
    rolling.refresh_recent(spark, path, "rt_lmps", feed, str(tmp_path / "checkpoint"), tiers.recent_rt, datetime(2024, 5, 1))
    assert rolling.read_recent(spark, path, datetime(2024, 5, 1)) is None


def test_reading_skips_older_folders(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "tier")
    land(spark, feed, "a", [(f"3/{d}/2024 9:00", "1", 1.0) for d in range(1, 8)])
    rolling.refresh_recent(spark, path, "rt_lmps", feed, str(tmp_path / "checkpoint"), tiers.recent_rt, datetime(2024, 3, 8), 7)
    assert len(folders(path)) == 7
    late = rolling.read_recent(spark, path, datetime(2024, 3, 8), 2)
    plan = late._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(feed_date" in plan
    read = late.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) == 2
