import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridmarts import schemas
from gridmarts.plans.staging import stage_da
from gridmarts.sources import normalise as N
from gridmarts.sources.feeds import conform, feed_window, first_landed, scan_feed, union_feeds
from gridmarts.sources.pages import unwrap_pages
from gridmarts.sources.sinks import write_feed, write_missing_periods


def test_absent_columns_and_other_types(spark, tmp_path):
    path = str(tmp_path / "da")
    spark.sql("select '1/5/2025 0:00' as datetime_beginning_ept, 51217L as pnode_id, '12.5' as total_lmp_da").write.parquet(path)
    feed = scan_feed(spark, path, "da_lmps", infer=True)
    assert feed.schema == schemas.DA_FEED
    row = feed.first()
    assert (row.pnode_id, row.total_lmp_da, row.source, row.zone) == ("51217", 12.5, None, None)
    landed = "datetime_beginning_ept string, pnode_id bigint, total_lmp_da string"
    from pyspark.sql.types import StructType

    stated = scan_feed(spark, path, "da_lmps", landed=StructType.fromDDL(landed))
    assert stated.collect() == feed.collect()


def test_union_of_two_sources(spark, rows):
    api = spark.sql("select '1' as pnode_id, 'ZONE' as type")
    backfill = spark.sql("select '2' as pnode_id, 'eia' as source")
    both = union_feeds(api, backfill)
    assert rows(both) == [("1", "ZONE", None), ("2", None, "eia")]


def test_first_landed(spark, tmp_path):
    hourly = str(tmp_path / "rt_lmps")
    spark.sql("select '1' as pnode_id").write.parquet(hourly)
    pairs = [("rt_5min", str(tmp_path / "rt_5min")), ("rt_lmps", hourly)]
    assert first_landed(spark, pairs)[0] == "rt_lmps"
    spark.sql("select '2' as pnode_id").write.parquet(str(tmp_path / "rt_5min"))
    assert first_landed(spark, pairs)[0] == "rt_5min"
    with pytest.raises(FileNotFoundError):
        first_landed(spark, [("load", str(tmp_path / "nothing"))])


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), "datetime_beginning_ept string, type string, n int")


def test_feed_window(spark, rows):
    raw = feed(
        spark,
        ("1/4/2025 23:00", "ZONE", 1),
        ("1/5/2025 0:00", "ZONE", 2),
        ("1/5/2025 1:00", "HUB", 3),
        ("2025-01-06 23:00:00", "ZONE", 4),
        ("1/7/2025 0:00", "ZONE", 5),
        ("unreadable", "ZONE", 6),
    )
    assert rows(feed_window(raw, "2025-01-05", "2025-01-06"), "n") == [(2,), (3,), (4,)]
    assert rows(feed_window(raw, "2025-01-05", type="ZONE"), "n") == [(2,)]
    assert rows(feed_window(raw, "yesterday", today=date(2025, 1, 5)), "n") == [(1,)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_landed_days_are_replaced_and_pruned(spark, rows, tmp_path, unit):
    path = str(tmp_path / "feed")
    write_feed(feed(spark, ("1/5/2025 0:00", "a", 1), ("2/6/2025 0:00", "a", 2)), path, unit=unit)
    write_feed(feed(spark, ("2/6/2025 0:00", "a", 20), ("2/6/2025 1:00", "a", 21)), path, unit=unit)
    stored = spark.read.parquet(path)
    assert rows(stored, "n") == [(1,), (20,), (21,)]
    window = feed_window(stored, "2025-02-06", "2025-02-07")
    assert rows(window, "n") == [(20,), (21,)]
    folder = "feed_date" if unit == "day" else "feed_month"
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({folder}" in plan


def test_missing_periods_only(spark, rows, tmp_path):
    path = str(tmp_path / "periods")
    make = lambda *r: spark.createDataFrame(list(r), "period string, n int")
    write_missing_periods(make(("2023", 1)), path, "period")
    write_missing_periods(make(("2023", 100), ("2024", 2), (None, 3)), path, "period")
    write_missing_periods(make(("2023", 100), ("2024", 200), (None, 300)), path, "period")
    assert rows(spark.read.parquet(path), "n") == [(1,), (2,), (3,)]


def test_parts_of_a_feed_share_days(spark, rows, tmp_path):
    path = str(tmp_path / "feed")
    write_feed(feed(spark, ("1/5/2025 0:00", "zone", 1), ("odd", "zone", 2)), path, part="zones")
    write_feed(feed(spark, ("1/5/2025 0:00", "hub", 3), ("odd", "hub", 4)), path, part="hubs")
    write_feed(feed(spark, ("1/5/2025 0:00", "hub", 5)), path, part="hubs")
    assert rows(spark.read.parquet(path), "n") == [(1,), (2,), (4,), (5,)]


def test_pages(spark, rows, tmp_path):
    row = lambda i: {"pnode_id": i, "total_lmp_da": i + 0.5, "type": "ZONE", "extra": True}
    documents = {
        "list": [row(1), row(2)],
        "items": {"items": [row(3)], "data": [row(9)]},
        "data": {"data": [row(4)], "totalRows": 1},
        "empty": {"items": []},
        "empty_list": [],
        "message": {"message": "no such feed"},
        "quoted": {"items": [{"pnode_id": "5", "total_lmp_da": "5.5"}]},
    }
    for name, document in documents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=1))
    whole = unwrap_pages(spark, str(tmp_path), "da_lmps")
    assert whole.schema == schemas.DA_FEED
    want = [(str(i), i + 0.5) for i in range(1, 6)]
    assert rows(whole, "pnode_id", "total_lmp_da") == want
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "pages.json").write_text("\n".join(json.dumps(d) for d in documents.values()))
    by_line = unwrap_pages(spark, str(lines), "da_lmps", whole_file=False)
    assert rows(by_line, "pnode_id", "total_lmp_da") == want


def test_a_broken_page_stops_the_job(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"items": [{"pnode_id": 1, "total_lmp_da": 1.5}')
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        unwrap_pages(spark, str(tmp_path), "da_lmps").collect()


def test_files_of_different_headers(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("Datetime,Zone,LMP DA,Congestion\n1/5/2025 0:00,A,1.5,0.1\n")
    (tmp_path / "b.csv").write_text("Datetime,Zone,Congestion,LMP DA\n1/5/2025 1:00,B,0.2,2.5\n")
    (tmp_path / "c.csv").write_text("period,respondent,value\n1/5/2025 2:00,C,3.5\n")
    got = N.normalise_files(spark, str(tmp_path), N.normalise_da_zones)
    assert rows(got, "pnode_name", "total_lmp_da", "congestion_price_da") == [
        ("A", "1.5", "0.1"), ("B", "2.5", "0.2"), ("C", "3.5", None),
    ]
    with pytest.raises(Exception, match="header|Header|HEADER"):
        N.read_csv(spark, str(tmp_path)).collect()


def csv(spark, tmp_path, text):
    (tmp_path / "file.csv").write_text(text)
    return N.read_csv(spark, str(tmp_path / "file.csv"))


def test_flat_csv(spark, tmp_path):
    out = N.normalise_da_zones(
        csv(spark, tmp_path, "Datetime Beginning, Zone-Name ,DA LMP,Energy Price,Marginal Loss,Respondent,Note\n"
            '1/5/2025 0:00,"A, ""B""",1.5,1.0,NA,51217,x\n')
    )
    row = out.first().asDict()
    assert row == {
        "datetime_beginning_ept": "1/5/2025 0:00",
        "pnode_name": 'A, "B"',
        "total_lmp_da": "1.5",
        "system_energy_price_da": "1.0",
        "marginal_loss_price_da": None,
        "pnode_id": "51217",
        "note": "x",
        "pnode_type": "ZONE",
        "zone": 'A, "B"',
        "type": "ZONE",
        "source": "eia",
    }


def test_date_and_hour_columns(spark, tmp_path):
    out = N.normalise_da_zones(csv(spark, tmp_path, "Date,Hour,Zone,LMP (DA)\n1/5/2025,7,DUQ,2\n1/5/2025,8:00,DUQ,3\n"))
    staged = stage_da(out).orderBy("hour_beginning_ept").collect()
    assert [r.hour_beginning_ept for r in staged] == [datetime(2025, 1, 5, 7), datetime(2025, 1, 5, 8)]
    assert staged[0].zone == "DUQ"
    assert staged[0].source == "eia"


def test_required_columns_are_added(spark, tmp_path):
    out = N.normalise_da_zones(csv(spark, tmp_path, "Respondent,Other\n51217,1\n"))
    row = out.first()
    assert (row.datetime_beginning_ept, row.pnode_name, row.total_lmp_da, row.zone) == (None,) * 4
    assert (row.pnode_id, row.type) == ("51217", "ZONE")


def test_api_layout_hubs_and_passthrough(spark, tmp_path):
    api = csv(spark, tmp_path, "period,respondent,respondent-name,value\n2025-01-05 00:00,DUQ,Duquesne,x\n2025-01-05 01:00,DUQ,Duquesne,4\n")
    out = N.normalise_da_zones(api)
    assert [r.total_lmp_da for r in out.collect()] == [None, 4.0]
    assert out.first().zone == "Duquesne"
    assert {r.type for r in N.normalise_da_hubs(api).collect()} == {"HUB"}
    ready = spark.sql("select 'x' as datetime_beginning_ept, 1D as total_lmp_da, 2D as total_lmp_rt")
    assert N.normalise_da_zones(ready).columns == ready.columns
    assert N.normalise_rt_zones(ready).first().source == "eia"


@pytest.mark.parametrize(
    ("header", "da", "rt"),
    [
        ("datetime_utc", "datetime_beginning_ept", "datetime_beginning_ept"),
        ("hour", "datetime_beginning_ept", None),
        ("lmp_da", "total_lmp_da", None),
        ("lmp_rt", None, "total_lmp_rt"),
        ("energy", None, "system_energy_price_rt"),
        ("energy_price", "system_energy_price_da", "system_energy_price_rt"),
        ("marginal_loss", "marginal_loss_price_da", "marginal_loss_price_rt"),
        ("respondent_name", "pnode_name", "pnode_name"),
        ("respondent", "pnode_id", "pnode_id"),
        ("units", None, None),
    ],
)
def test_header_rules(header, da, rt):
    assert N.target_of(header, N.DA_RULES, "_da") == da
    assert N.target_of(header, N.RT_RULES, "_rt") == rt


def test_conform_keeps_folder_columns(spark):
    df = spark.sql("select date'2025-01-01' as feed_date, 1 as pnode_id").withColumn("junk", F.lit(1))
    assert conform(df, schemas.RT_FEED).columns == [*schemas.RT_FEED.names, "feed_date"]
