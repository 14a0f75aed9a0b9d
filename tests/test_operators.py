from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridmarts.operators import file_upsert
from gridmarts.operators.latest import latest_by
from gridmarts.operators.quality import check_not_null, check_unique
from gridmarts.operators.ranking import rank_descending
from gridmarts.operators.upsert import (
    high_water,
    merge_frames,
    newer_than,
    read_table,
    upsert_table,
    write_history,
)
from gridmarts.plans.kpi import duration_curve

KEYS = ["t", "node"]
SCHEMA = "t timestamp_ntz, node int, price double"


def hour(day, h=0):
    return datetime(2024, 1, day, h)


def table(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_latest_version_wins_and_ties_are_definite(spark, rows):
    versions = spark.createDataFrame(
        [
            ("A", 1, 10, 5.0, "x"),
            ("A", 1, 12, 4.0, "y"),
            ("A", 1, 12, 6.0, "z"),
            ("A", 1, None, 9.0, "w"),
            ("B", 1, None, 1.0, "v"),
            (None, 1, 3, 1.0, "u"),
            (None, 1, 4, 2.0, "t"),
        ],
        "area string, hour int, at int, load double, note string",
    )
    kept = latest_by(versions, ["area", "hour"], ["at", "load"])
    assert kept.columns == versions.columns
    assert rows(kept) == [("A", 1, 12, 6.0, "z"), ("B", 1, None, 1.0, "v"), (None, 1, 4, 2.0, "t")]


def test_merge_replaces_equal_keys_and_keeps_null_keys(spark, rows):
    stored = table(spark, (hour(1), 1, 1.0), (hour(1), 2, 2.0), (hour(1), None, 3.0))
    batch = table(spark, (hour(1), 2, 20.0), (hour(1), None, 30.0), (hour(2), 1, 40.0))
    assert rows(merge_frames(stored, batch, KEYS)) == [
        (hour(1), 1, 1.0),
        (hour(1), 2, 20.0),
        (hour(1), None, 3.0),
        (hour(1), None, 30.0),
        (hour(2), 1, 40.0),
    ]


def test_merge_gives_one_row_per_key(spark, rows):
    stored = table(spark, (hour(1), 1, 1.0), (hour(1), None, 3.0))
    batch = spark.createDataFrame(
        [(hour(1), 1, 9.0, 1), (hour(1), 1, 5.0, 2), (hour(1), None, 3.0, 1), (hour(1), None, 3.0, 2)],
        "t timestamp_ntz, node int, price double, landed_at int",
    )
    merged = merge_frames(stored, batch, KEYS)
    assert merged.columns == ["t", "node", "price"]
    # the newest row of a key; a row without a key once, however often it comes
    assert rows(merged) == [(hour(1), 1, 5.0), (hour(1), None, 3.0)]


def test_rows_of_a_key_stay_where_none_is_newer(spark, rows, tmp_path):
    """As in a table built anew, whatever the number of times that they come."""
    stored = table(spark, (hour(1), 1, 1.0), (hour(1), 2, 2.0))
    batch = table(spark, (hour(1), 1, 9.0), (hour(1), 1, 5.0))
    expected = [(hour(1), 1, 5.0), (hour(1), 1, 9.0), (hour(1), 2, 2.0)]
    assert rows(merge_frames(stored, batch, KEYS)) == expected
    write_history(str(tmp_path / "table"), stored, KEYS, "t")
    for _ in range(2):
        upsert_table(spark, str(tmp_path / "table"), batch, KEYS, "t")
        assert rows(read_table(spark, str(tmp_path / "table")), "t", "node", "price") == expected


def test_merge_with_new_and_missing_columns(spark, rows):
    stored = table(spark, (hour(1), 1, 1.0), (hour(1), 2, 2.0))
    batch = spark.createDataFrame([(hour(1), 2, "new")], "t timestamp_ntz, node int, note string")
    merged = merge_frames(stored, batch, KEYS)
    assert merged.columns == ["t", "node", "price", "note"]
    assert rows(merged) == [(hour(1), 1, 1.0, None), (hour(1), 2, None, "new")]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_upsert_table(spark, rows, tmp_path, unit):
    path = str(tmp_path / "table")
    upsert_table(spark, path, table(spark, (hour(1), 1, 1.0), (hour(2), 1, 2.0), (None, 5, 9.0)), KEYS, "t", unit)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    batch = spark.createDataFrame(
        [(hour(2), 1, 20.0, "b"), (hour(3), 1, 3.0, "b")],
        "t timestamp_ntz, node int, price double, note string",
    )
    for _ in range(2):  # the second time changes nothing
        upsert_table(spark, path, batch, KEYS, "t", unit)
        assert rows(read_table(spark, path), "t", "node", "price", "note") == [
            (hour(1), 1, 1.0, None),
            (hour(2), 1, 20.0, "b"),
            (hour(3), 1, 3.0, "b"),
            (None, 5, 9.0, None),
        ]
    if unit == "day":
        untouched = [p for p in before if "date_utc=2024-01-01" in str(p)]
        assert untouched
        assert all(p.stat().st_mtime_ns == before[p] for p in untouched)


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def stored_in_files(spark, path, parts=4):
    """One day in several files, each with nodes of its own, and a day that no batch touches."""
    for node in range(parts):
        rows = [(hour(1, h), node, 1.0 * node) for h in range(24)] + [(hour(2), node, 5.0)]
        one = table(spark, *rows).withColumn("date_utc", F.to_date("t")).coalesce(1)
        one.write.mode("append").partitionBy("date_utc").parquet(str(path))


def test_one_row_rewrites_one_file(spark, rows, tmp_path):
    path = tmp_path / "a table"  # names of files come as URIs
    stored_in_files(spark, path)
    before = files_of(path)
    batch = table(spark, (hour(1, 3), 2, 99.0))
    assert len(file_upsert.upsert_files(spark, str(path), batch, KEYS, "t")) == 1
    after = files_of(path)
    assert len(after) == len(before) and len([p for p in before if after.get(p) == before[p]]) == len(before) - 1
    got = read_table(spark, str(path))
    assert got.count() == 4 * 25
    assert rows(got.where("price = 99"), "t", "node", "price") == [(hour(1, 3), 2, 99.0)]
    assert {p.name for p in path.iterdir() if p.name.startswith("_s") or p.name.startswith("_r")} == set()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_upsert_by_file_equals_upsert_by_folder(spark, rows, tmp_path, unit):
    first = table(spark, (hour(1), 1, 1.0), (hour(2), 1, 2.0), (None, 5, 9.0), (hour(2), None, 4.0))
    batches = [
        table(spark, (hour(2), 1, 20.0), (hour(2), 1, 21.0), (hour(3), 1, 3.0), (None, 5, 9.0), (hour(2), None, 4.0)),
        table(spark),
        table(spark, (hour(1), 7, 1.5), (None, 6, 1.0)).withColumn("note", F.lit("new")),
    ]
    one, other = str(tmp_path / "files"), str(tmp_path / "folders")
    for batch in [first, *batches, *batches]:
        file_upsert.upsert_files(spark, one, batch, KEYS, "t", unit)
        upsert_table(spark, other, batch, KEYS, "t", unit)
        columns = [c for c in ("t", "node", "price", "note") if c in read_table(spark, other).columns]
        assert rows(read_table(spark, one), *columns) == rows(read_table(spark, other), *columns)


def test_a_broken_exchange_is_carried_through(spark, rows, tmp_path, monkeypatch):
    """The driver dies before, or in the middle of, the exchange of files."""
    path = tmp_path / "table"
    stored_in_files(spark, path)
    whole, calls = file_upsert.finish_exchange, []

    def dies(spark, path):
        calls.append(path)
        if len(calls) == 2:  # the first call only looks for leftovers
            raise KeyboardInterrupt
        whole(spark, path)

    monkeypatch.setattr(file_upsert, "finish_exchange", dies)
    batch = table(spark, (hour(1, 3), 2, 99.0), (hour(4), 2, 4.0))
    with pytest.raises(KeyboardInterrupt):
        file_upsert.upsert_files(spark, str(path), batch, KEYS, "t")
    assert read_table(spark, str(path)).count() == 4 * 25  # nothing seen of it yet
    # one of the two staged files has moved already
    staged = next((path / "_staged").rglob("date_utc=2024-01-01/*.parquet"))
    staged.rename(path / "date_utc=2024-01-01" / staged.name)
    file_upsert.upsert_files(spark, str(path), table(spark), KEYS, "t")
    got = read_table(spark, str(path))
    assert got.count() == 4 * 25 + 1
    assert rows(got.where("price = 99 or t = '2024-01-04'"), "t", "node", "price") == [(hour(1, 3), 2, 99.0), (hour(4), 2, 4.0)]


def test_what_was_staged_without_a_list_goes(spark, tmp_path):
    path = tmp_path / "table"
    stored_in_files(spark, path)
    table(spark, (hour(9), 9, 9.0)).write.parquet(str(path / "_staged" / "date_utc=2024-01-09"))
    file_upsert.finish_exchange(spark, str(path))
    assert read_table(spark, str(path)).count() == 4 * 25 and not (path / "_staged").exists()


def test_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert_table(spark, path, table(spark), KEYS, "t")
    assert read_table(spark, path) is None


def test_newer_than(spark, rows, tmp_path):
    source = table(spark, (hour(1), 1, 1.0), (hour(2), 1, 2.0), (hour(2, 1), 1, 3.0))
    stored = source.filter(F.col("t") < F.lit(hour(2, 1)).cast("timestamp_ntz"))
    assert rows(newer_than(source, stored, "t"), "price") == [(3.0,)]
    assert rows(newer_than(source, stored, "t", lookback_hours=2), "price") == [(2.0,), (3.0,)]
    assert newer_than(source, stored.filter("false"), "t").count() == 3
    assert newer_than(source, None, "t").count() == 3
    path = str(tmp_path / "table")
    write_history(path, stored, KEYS, "t")
    on_disk = read_table(spark, path)
    assert rows(newer_than(source, on_disk, "t"), "price") == [(3.0,)]
    assert spark.range(1).select(high_water(on_disk, "t")).first()[0] == hour(2)


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_rank_with_ties_over_many_tasks(spark, rows, buckets):
    values = [5.0] * 40 + [float(i % 17) for i in range(100)] + [None] * 5 + [-3.5]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = rank_descending(df, "x", buckets=buckets, rows_per_chunk=7)
    want = sorted((v for v in values if v is not None), reverse=True)
    assert [r["x"] for r in got.orderBy("position").collect()] == want
    assert [r["position"] for r in got.orderBy("position").collect()] == list(range(len(want)))
    assert {r["total"] for r in got.collect()} == {len(want)}


def test_duration_curve(spark, rows):
    prices = spark.createDataFrame([(3.0,), (None,), (1.0,), (2.0,)], "da double")
    assert rows(duration_curve(prices)) == [(0.0, 3.0), (100.0, 1.0), (50.0, 2.0)]
    assert rows(duration_curve(prices.filter("da = 1"))) == [(None, 1.0)]
    assert rows(duration_curve(prices.filter("da > 9"))) == []


def test_quality(spark, rows):
    df = table(spark, (hour(1), 1, 1.0), (hour(1), 1, None), (hour(1), None, 2.0), (hour(1), None, 2.0))
    assert rows(check_not_null(df, ["t", "node", "price"])) == [("node", 2), ("price", 1), ("t", 0)]
    assert rows(check_unique(df, KEYS)) == [(hour(1), 1, 2)]
