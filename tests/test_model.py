"""The model on the smallest test data: known counts, invariants, the full build."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from supplylens.operators import dashboard
from supplylens.plans.model import TABLES, Model, build
from supplylens.sources.readers import StarSchemaSources
from supplylens.sources.store import EXPORT_TABLES, TableStore, planning_extract, write_extract


@pytest.fixture(scope="module")
def built(spark, small, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("store")))
    counts = build(spark, StarSchemaSources(spark, small), store)
    return store, counts


def test_every_table_is_published(built):
    store, counts = built
    assert set(store.published()) == set(TABLES) and set(EXPORT_TABLES) <= set(TABLES)
    assert counts["fact_purchase_order"] == counts["purchase_order_summary"] == 5213
    assert counts["inventory_position"] == 4939 and counts["vendor_sales_summary"] == 647


def test_known_order_counts(built):
    po = built[0].table("fact_purchase_order")
    status = {r[0]: r[1] for r in po.groupBy("PurchaseOrderMatchStatus").count().collect()}
    assert status == {"Matched": 3299, "Purchase only": 4883 - 3299, "Invoice only": 330}
    buckets = {r[0]: r[1] for r in po.where("PurchaseOrderMatchStatus <> 'Invoice only'").groupBy("POCycleAgingBucket").count().collect()}
    assert buckets == {"0-7 days": 1527, "8-15 days": 2816, "16-30 days": 104, "31-60 days": 236, "60+ days": 110, None: 90}


def test_known_inventory_counts(built):
    inv = built[0].table("fact_inventory_summary")
    row = inv.agg(F.sum("BeginningUnits"), F.sum("EndingUnits"), F.sum("LowInventoryFlag")).first()
    assert tuple(row) == (115120.0, 93187.0, 122)


def test_shares_add_up(built):
    store = built[0]
    perf = store.table("vendor_performance_summary")
    row = perf.agg(F.sum("PurchaseContributionPct"), F.max("CumulativePurchaseContributionPct"), F.min("VendorSpendRank")).first()
    assert abs(row[0] - 100) < 1e-9 and abs(row[1] - 100) < 1e-9 and row[2] == 1
    shares = store.table("po_cycle_aging_summary").agg(F.sum("ShareOfObservedPOsPct")).first()[0]
    assert abs(shares - 100) < 1e-9


def test_otif_stays_null(built):
    row = built[0].table("fact_supplier_performance").agg(F.count("OTIFPct"), F.count("OnTimePct"), F.count("InFullPct")).first()
    assert tuple(row) == (0, 0, 0)


def test_risk_rows_follow_the_scorecard(built):
    store = built[0]
    assert store.table("procurement_planning_risk").count() == store.table("fact_supplier_performance").count()
    bad = store.table("procurement_planning_risk").where("RiskFlagCount > 6 OR RiskFlagCount < 0")
    assert bad.count() == 0


def test_pages_read_published_tables(built):
    store = built[0]
    tables = {t: store.table(t) for t in TABLES}
    for page in dashboard.PAGES:
        visuals = dashboard.page(tables, page)
        assert len(visuals) == len(dashboard.PAGES[page])
    row = dashboard.card(tables["chart_po_key_metrics"], "Value", "PurchaseSidePOKeys").first()
    assert row.Value == 4883.0


def test_extract_parts(spark, built, tmp_path):
    tables = {t: built[0].table(t) for t in TABLES}
    parts = planning_extract(spark, tables, {"Validated purchase spend target": 1.0})
    assert len(parts["Supplier Scorecard"].columns) == 20
    assert parts["Methodology Notes"].count() == 5
    small_parts = {k: parts[k] for k in ("PO Cycle Aging", "Methodology Notes")}
    assert write_extract(small_parts, str(tmp_path)) == list(small_parts)


def test_failed_validation_publishes_nothing(spark, small, tmp_path, monkeypatch):
    from supplylens.operators.quality import DataQualityError
    from supplylens.plans import model

    keep = {k: TABLES[k] for k in ("inventory_position", "vendor_sales_summary")}
    monkeypatch.setattr(model, "TABLES", keep)
    monkeypatch.setattr(Model, "summary_checks", lambda self: spark.sql("SELECT 'x' AS Measure, false AS Reconciles"))
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(DataQualityError):
        model.build(spark, StarSchemaSources(spark, small), store)
    assert store.published() == {}


def test_filter_and_columns_reach_the_scan(spark, small):
    from supplylens.operators import eda
    from supplylens.sources.readers import StarSchemaSources

    rows = StarSchemaSources(spark, small).table("purchases", "VendorNumber", "Brand", "PONumber", "Quantity", "Dollars")
    plan = eda.vendor_rows(rows, 6)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in plan and "l_discount" not in plan and "p_name" not in plan
