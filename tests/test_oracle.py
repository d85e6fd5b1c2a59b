"""Every query against its SQL on the smallest test tables, and plan checks."""

import os

import pytest

from checks import cases
from checks.compare import differences, duck_tables
from checks.sql import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) == set(cases.CASES) and len(ORACLE) == 81


@pytest.mark.parametrize("name", list(cases.CASES))
def test_query(spark, con, name):
    assert differences(spark, con, SF_DIR, name) == []


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PLANNED = ["orders_fact", "customer_base", "customer_rfm", "monthly_revenue", "report_categories",
           "bronze_shipments", "silver_shipments", "carrier_kpis", "alerts_topk", "kpi_lookback",
           "indicator_flatten", "indicator_facets", "yoy_snapshot", "yoy_series",
           "pivot_recent_years", "load_summary"]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_workers_or_cross_joins(spark, name):
    text = plan(cases.CASES[name](spark, SF_DIR))
    for bad in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in text


def test_messages_are_parsed_once(spark):
    assert plan(cases.CASES["carrier_kpis"](spark, SF_DIR)).count("from_json(") == 1


@pytest.mark.parametrize("name", ["customer_rfm", "silver_shipments", "orders_fact"])
def test_no_single_task_exchange(spark, name):
    text = plan(cases.CASES[name](spark, SF_DIR))
    assert "SinglePartition" not in text


def test_one_row_per_order(spark):
    fact = cases.CASES["orders_fact"](spark, SF_DIR)
    assert fact.count() == fact.select("order_id").distinct().count()
