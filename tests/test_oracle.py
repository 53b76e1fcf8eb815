"""Every registered query against its DuckDB oracle (default sf0.001; set
CARTWHEEL_TEST_SF=/root/testdata/sf0.01 for the driver's scale)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cartwheel import registry
from oracle_compare import compare, duck

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), sf_dir, con)
    assert res["status"] == "ok", res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["click_daily_funnel", "monthly_revenue", "top_customers"])
def test_no_round_robin_shuffle(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "event_date"
    assert df.count() > 0
