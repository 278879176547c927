"""Steps leave no shuffle files behind, come one after the other, and extracts of a round trip are packed."""

from __future__ import annotations

import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from supplylens.functions import workspace
from supplylens.operators import dims, summary
from supplylens.plans import model as models
from supplylens.plans import registry
from supplylens.sources import readers, store


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(k).getName() for k in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    for _ in range(100):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.1)
    return False


def grouped(spark):
    return spark.range(5000, numPartitions=4).groupBy((F.col("id") % 700).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path):
    before = shuffle_files(spark)
    held = workspace.hold(grouped(spark), "grouped")
    assert gone(spark, before)
    tables = store.TableStore(spark, f"{tmp_path}/store")
    tables.stage(grouped(spark), "grouped", tables.new_run())
    assert gone(spark, before)
    store.write_csv(grouped(spark), f"{tmp_path}/grouped.csv")
    assert gone(spark, before) and held.count() == 700


def test_the_sessions_setting_comes_back(spark, tmp_path):
    def now():
        return spark.conf.get(workspace.SHUFFLE_CLEANUP)

    before = now()
    with workspace.shuffles_go(spark):
        with workspace.shuffles_go(spark):
            assert now() == "true"
        assert now() == "true"
    assert now() == before
    with pytest.raises(Exception, match="no such thing"):
        workspace.hold(spark.range(3).select(F.raise_error(F.lit("no such thing")).alias("x")))
    assert now() == before


def test_tables_are_held_one_after_the_other(spark, small, monkeypatch):
    steps = []

    def noted(df, label="table"):
        steps.append((label, "begins"))
        held = hold(df, label)
        steps.append((label, "ends"))
        return held

    hold = models.hold
    monkeypatch.setattr(models, "hold", noted)
    mark = workspace.written()
    model = models.Model(readers.StarSchemaSources(spark, small))
    model.hold_all("fact_procurement_monthly", "dim_supplier", "dim_brand", "dim_supplier")
    names = ("fact_procurement_monthly", "dim_supplier", "dim_brand")
    assert steps == [(n, s) for n in names for s in ("begins", "ends")]
    workspace.release_since(spark, mark)


def test_every_relationship_is_written_by_itself(spark):
    def fact(key, values):
        return spark.createDataFrame([(v,) for v in values], f"{key} int")

    days = spark.sql("SELECT date'2024-01-01' AS FullDate")
    ordered = spark.createDataFrame([(1,), (1,), (9,), (None,)], "VendorNumber int").withColumn("PODate", F.lit("2024-01-01").cast("date"))
    mark = workspace.written()
    found = dims.relationship_check({
        "dim_supplier": fact("VendorNumber", [1, 2]), "dim_brand": fact("Brand", [5]), "dim_store": fact("Store", [None]),
        "dim_date": days, "fact_purchase_order": ordered, "fact_supplier_performance": fact("VendorNumber", [2]),
        "fact_procurement_monthly": fact("Brand", []), "fact_inventory_summary": fact("Store", [4, None, None]),
    })
    assert [(r.FactRows, r.OrphanRows) for r in found.collect()] == [(4, 2), (1, 0), (0, 0), (3, 3), (4, 0)]
    names = [re.sub(r"-[0-9a-f]{32}$", "", p.rsplit("/", 1)[1]) for p in workspace._FOLDERS[mark:]]
    assert names.count("relationship") == 5 and names.count("dim_supplier_keys") == 1
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    workspace.release_since(spark, mark)


def test_extracts_of_a_round_trip_are_packed_and_exports_are_not(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "new_folder", lambda spark, label: str(tmp_path / "extracts"))
    found = registry.QUERIES["ingest_round_trip"](spark, small)
    parts = list((tmp_path / "extracts").glob("*.csv/part-*"))
    assert len({p.parent for p in parts}) == 6 and all(p.name.endswith(".csv.gz") for p in parts)
    plain = registry._per_table(lambda m, t: registry._profile(t, m.src.table(t)))(
        models.Model(readers.StarSchemaSources(spark, small))
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    odd = spark.createDataFrame([(" a\"b, c ", 1), ("", 2), (None, 3)], "x string, n int")
    for packed in (False, True):
        store.write_csv(odd, f"{tmp_path}/odd-{packed}", packed)
        assert all(p.name.endswith(".gz") == packed for p in Path(f"{tmp_path}/odd-{packed}").glob("part-*"))
    back = [spark.read.options(header=True, escape='"').csv(f"{tmp_path}/odd-{p}").collect() for p in (False, True)]
    assert sorted(map(str, back[0])) == sorted(map(str, back[1])) and len(back[0]) == 3


@pytest.fixture
def star(spark, tmp_path):
    """300 orders of four lines each, some of status P, one without a number."""
    lines = [(o, (o * 7 + n * 3) % 60, o % 8, n, 1.0 + n, 10.0 * n) for o in range(300) for n in range(1, 5)] + [(None, 5, 1, 1, 1.0, 1.0)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double"
    ).withColumns({c: F.lit(0.0) for c in ("l_discount", "l_tax")}).withColumns(
        {"l_returnflag": F.lit("N"), "l_shipdate": F.lit("1996-02-01").cast("date")}
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 9, "FOP"[o % 3]) for o in range(300)], "o_orderkey long, o_custkey long, o_orderstatus string").withColumn(
        "o_orderdate", F.lit("1996-01-01").cast("date")
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, f"vendor {k}") for k in range(8)], "s_suppkey long, s_name string").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"part {k}", k % 9, 1.0) for k in range(60)], "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_orders_of_both_sides_meet_where_they_were_dealt(spark, star, monkeypatch):
    def summary_of():
        return models.Model(readers.StarSchemaSources(spark, star)).table("fact_purchase_order")

    few = sorted(map(str, summary_of().collect()))
    monkeypatch.setattr(readers, "TASK_ROWS", 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")  # suppliers, but not orders
    try:
        df = summary_of()
        moves = re.findall(r"Exchange hashpartitioning\(.*", df._jdf.queryExecution().executedPlan().toString())
        assert moves and all("REPARTITION_BY_NUM" in x for x in moves)
        assert sorted(map(str, df.collect())) == few and len(few) > 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_summary_facts_follow_purchases_and_prices_either_side(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    bought = frame(
        [(1, 5, "V", "d", 10, 100.0, 10.0), (2, 6, "W", "e", 4, 8.0, 2.0), (2, 7, "W", "e", 1, 2.0, 2.0), (3, 7, "X", "e", 1, 2.0, 2.0), (None, 5, "N", "n", 1, 1.0, 1.0)],
        "VendorNumber int, Brand int, VendorName string, Description string, Quantity long, Dollars double, PurchasePrice double",
    )
    sold = frame(
        [(1, 5, "V", "d", 150.0, 6, 1.0, 25.0), (1, 6, "V", "e", 9.0, 3, 0.0, 3.0), (2, None, "W", "z", 1.0, 1, 0.0, 1.0)],
        "VendorNo int, Brand int, VendorName string, Description string, SalesDollars double, SalesQuantity long, ExciseTax double, SalesPrice double",
    )
    prices = frame([(1, 5, 20.0, 8.0, "750"), (1, 6, 30.0, 9.0, "x")], "VendorNumber int, Brand int, Price double, PurchasePrice double, Volume string")
    invoices = frame([(1, 50.0), (None, 7.0)], "VendorNumber int, Freight double")
    stock = frame([(5, 1, 1, 4.0, 2.0, 40.0), (6, 2, 1, 4.0, 2.0, 40.0)], "Brand int, StoreCount long, CompleteStoreCount long, AverageInventoryUnits double, EndingInventoryUnits double, EndingInventoryRetailValue double")
    found = summary.vendor_sales_summary(bought, sold, prices, invoices, stock).collect()
    kept = {(r.VendorNumber, r.Brand): (r.ActualPrice, r.ReferencePurchasePrice, r.Volume, r.FreightCost, r.AverageInventoryUnits, r.StockTurnover) for r in found}
    assert len(kept) == len(found) == 7
    nothing = (None,) * 6
    # the vendors of brand 5 are one by number; of vendor 2 there is no freight
    assert kept == {
        (1, 5): (20.0, 8.0, 750.0, 50.0, 4.0, 1.5), (1, 6): (30.0, 9.0, None, None, None, None), (2, 6): nothing,
        (2, 7): nothing, (3, 7): nothing, (None, 5): nothing, (2, None): nothing,
    }
