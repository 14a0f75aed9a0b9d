"""Every query against its oracle, and a few properties of the plans."""

import pytest

import __spark_entry__ as contract
from acceptance.check import compare, duckdb_views
from acceptance.oracles import all_oracles
from acceptance.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_oracle(spark, con, name):
    bad, found, _seconds = compare(spark, con, name, SF_DIR)
    assert bad == []
    assert found > 0


def test_entry(spark):
    assert contract.entry(spark).columns == contract.queries()["lmp_daily"](spark, SF_DIR).columns


@pytest.mark.parametrize("name", ["mart_lmps", "mart_load", "lmp_daily", "stg_forecast_latest", "lmp_series_daily"])
def test_plans_stay_on_built_in_operators(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = contract.queries()["dim_pnode"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(total_lmp_da)]" in plan
    assert "congestion_price_da" not in plan
