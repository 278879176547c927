"""Registered queries against their SQL.

The quick ones by default; ALL_QUERIES=1 runs every query.
"""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

from supplylens.plans.registry import ORACLES, QUERIES

QUICK = (
    "purchase_order_summary", "delivery_reconciliation", "inventory_summary", "purchase_summary",
    "sales_summary", "vendor_sales_summary", "dim_supplier", "dim_date", "procurement_monthly",
    "supplier_lead_time", "brand_lead_time", "planning_risk", "key_overlap", "stats_tertiles",
    "chart_aging_buckets", "order_lines",
)


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, con, small, name):
    assert differences(spark, con, small, name, QUERIES[name], ORACLES[name]) == []


@pytest.mark.parametrize("table", ["purchases", "sales", "purchase_prices", "begin_inventory", "end_inventory"])
def test_source_tables_have_a_preview(spark, con, small, table):
    name = f"source_preview_{table}"
    assert differences(spark, con, small, name, QUERIES[name], ORACLES[name]) == []
    assert QUERIES[name](spark, small).count() == 5
