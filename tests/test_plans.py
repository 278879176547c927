"""Plans that must keep their shape, and checks that must fail."""

from __future__ import annotations

import re

import pytest

from supplylens.functions import workspace
from supplylens.functions.frames import merge, merge_left
from supplylens.operators import audit, eda, stats
from supplylens.plans.model import Model
from supplylens.plans.registry import QUERIES
from supplylens.sources.readers import StarSchemaSources


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["purchase_order_summary", "purchase_orders", "invoice_orders", "dim_supplier", "dim_store", "procurement_monthly"]
)
def test_no_raw_row_is_sorted_for_a_label(spark, small, name):
    lines = plan(QUERIES[name](spark, small)).split("\n")
    scans = [k for k, line in enumerate(lines) if "FileScan" in line and "l_orderkey" in line]
    assert scans
    for k in scans:  # the first aggregate above each scan of raw lines
        first = next(line for line in reversed(lines[:k]) if "Aggregate(" in line)
        assert "HashAggregate(" in first, first
    assert "Expand" not in "\n".join(lines)


@pytest.mark.parametrize("name", ["vendor_rows", "purchase_orders", "sales_summary", "dim_date"])
def test_no_exchange_is_added_to_the_scan(spark, small, name):
    assert "REPARTITION" not in plan(QUERIES[name](spark, small))


def test_one_to_one_merges_fail_on_a_repeated_key(spark):
    once = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    twice = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, y int")
    assert merge_left(once, twice, ["k"]).count() == 3
    for left, right in ((once, twice), (twice.withColumnRenamed("y", "x"), once.withColumnRenamed("x", "y"))):
        with pytest.raises(Exception, match="more than one row for k: NULL"):
            merge_left(left, right, ["k"], one_to_one=True).collect()
    assert merge_left(once, once.withColumnRenamed("x", "y"), ["k"], one_to_one=True).count() == 2


def test_combined_pairs_fail_on_a_repeated_pair(spark):
    bought = spark.createDataFrame([(1, 1, 5), (1, 1, 6)], "Vendor int, Brand int, PurchaseRows int")
    sold = spark.createDataFrame([(1, 1, 5)], "Vendor int, Brand int, SalesRows int")
    with pytest.raises(Exception, match="more than one row"):
        audit.combined_pairs(bought, sold).collect()


def test_welch_without_spread_is_null(spark):
    flat = spark.createDataFrame([("Top", 1.0), ("Top", 1.0), ("Low", 2.0), ("Low", 2.0)], "SalesGroup string, ProfitMargin double")
    assert tuple(stats.welch_test(flat).first()) == (None, None, None, None)


def test_shared_parents_are_written_once(spark, small):
    mark = workspace.written()
    QUERIES["page_executive_overview"](spark, small)
    names = [re.sub(r"-[0-9a-f]{32}$", "", p.rsplit("/", 1)[1]) for p in workspace._FOLDERS[mark:]]
    assert names.count("scorecard") == names.count("scores") == names.count("fact_supplier_performance") == 1
    workspace.release_since(spark, mark)


def test_nothing_overlaps_gives_zero(spark, small):
    model = Model(StarSchemaSources(spark, small))
    sales = model.src.table("sales", *audit.SALES_COLUMNS).withColumn("VendorNo", -1 - spark.range(1).selectExpr("0").scalar())
    row = audit.audit(
        model.src.table("purchases", *audit.PURCHASE_COLUMNS), sales,
        model.src.table("purchase_prices", "VendorNumber", "Brand"),
        model.src.table("vendor_invoice", "VendorNumber", "PONumber"),
        model.src.table("begin_inventory", "Store", "Brand"), model.src.table("end_inventory", "Store", "Brand"),
    ).first()
    assert row.sales_revenue_on_keys_with_purchases == 0.0 and row.sales_vendor_brand_keys_with_purchases == 0


def test_a_merge_shuffles_every_side_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sides = [spark.range(9).selectExpr("id AS k", "CAST(NULL AS string) AS j", f"id AS x{n}") for n in range(4)]
        merged = merge(sides[0], sides[1:], ["k", "j"], "left", one_to_one=True)
        assert len(re.findall(r"\bExchange hashpartitioning", plan(merged))) == 4
        assert merged.where("x3 = k and x1 = x2").count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_few_writes_come_before_the_planning_risk(spark, small):
    mark = workspace.written()
    QUERIES["planning_risk"](spark, small)
    names = [re.sub(r"-[0-9a-f]{32}$", "", p.rsplit("/", 1)[1]) for p in workspace._FOLDERS[mark:]]
    workspace.release_since(spark, mark)
    assert len(names) <= 10 and names.count("cells") == names.count("scores") == 1


def test_the_audit_scans_every_table_once(spark, small, monkeypatch, tmp_path):
    source = StarSchemaSources(spark, small)
    columns = (
        ("purchases", audit.PURCHASE_COLUMNS), ("sales", audit.SALES_COLUMNS), ("purchase_prices", ("VendorNumber", "Brand")),
        ("vendor_invoice", ("VendorNumber", "PONumber")), ("begin_inventory", ("Store", "Brand")), ("end_inventory", ("Store", "Brand")),
    )
    tables = []
    for name, wanted in columns:
        source.table(name, *wanted).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    written = {}
    monkeypatch.setattr(audit, "hold_together", lambda frames, hold=audit.hold_together: written.update(frames) or hold(frames))
    row = audit.audit(*tables)
    assert str(tmp_path) not in plan(row)
    assert sorted(len(re.findall("FileScan", plan(df))) for df in written.values()) == [1, 1, 1, 1, 2]


def test_a_type_profile_scans_its_table_once(spark, tmp_path):
    rows = [(k % 7 if k % 5 else None, f"t{k}" if k % 3 else "", float(k), None) for k in range(500)]
    spark.createDataFrame(rows, "o int, t string, x double, n string").repartition(6).write.parquet(str(tmp_path / "t"))
    profile = eda.type_profile(spark.read.parquet(str(tmp_path / "t")), ["o", "x"], 30)
    assert len(re.findall("FileScan", plan(profile))) == 1
    assert {tuple(r) for r in profile.collect()} == {
        ("o", 30, 30, "DOUBLE"), ("t", 30, 0, "STRING"), ("x", 30, 30, "DOUBLE"), ("n", 0, 0, "STRING")
    }
    first = eda._first_values(spark.read.parquet(str(tmp_path / "t")), ["o", "x"], 4).where("column = 't'").collect()
    want = sorted(((-1 if o is None else o, x), t) for o, t, x, _ in rows if t)[:4]
    assert sorted(r.v for r in first) == sorted(t for _, t in want)
