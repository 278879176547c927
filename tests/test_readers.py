"""The star-schema reader: the tasks of the inventory snapshots follow the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from supplylens.operators import audit, inventory
from supplylens.sources import readers


@pytest.fixture
def star(spark, tmp_path):
    """400 orders of five lines each; some keys are null or repeat."""
    orders = [(k, None if k == 7 else k * 31 % 250, "F") for k in range(400)]
    lines = [(o, None if o == 9 else (o * 7 + n * 3) % 60) for o, _, _ in orders for n in range(5)] + [(None, 5)]
    parts = [(k, f"part {k}", k % 9, 10.0 + k) for k in range(60)]
    dated = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string")
    dated.withColumn("o_orderdate", F.lit("1996-01-01").cast("date")).write.parquet(f"{tmp_path}/orders.parquet")
    rest = {c: F.lit(1) for c in readers.LINE_COLUMNS if c not in ("l_orderkey", "l_partkey")}
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").withColumns(rest).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k,) for k in range(8)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    positions = {
        (None if cust is None else cust % 80 + 1, part)
        for (o, part) in lines if o is not None and part is not None
        for cust in [orders[o][1]]
    }
    return str(tmp_path), positions


def test_tasks_of_the_snapshots_follow_the_rows(spark, star, monkeypatch):
    monkeypatch.setattr(readers, "TASK_ROWS", 50, raising=False)
    folder, _ = star
    source = readers.StarSchemaSources(spark, folder)
    begin, end = (source.table(t, *inventory.SNAPSHOT_COLUMNS) for t in ("begin_inventory", "end_inventory"))
    tasks = 41  # 2001 lines, 50 a task
    assert begin.rdd.getNumPartitions() == end.rdd.getNumPartitions() == tasks
    assert inventory.inventory_position(begin, end).rdd.getNumPartitions() == tasks
    coverage = audit.position_coverage(begin.select("Store", "Brand"), end.select("Store", "Brand"))
    assert coverage.rdd.getNumPartitions() == tasks


def test_snapshots_hold_every_position_once(spark, star):
    folder, positions = star
    found = readers.StarSchemaSources(spark, folder).table("begin_inventory", "Store", "Brand").collect()

    def kept(s, b):
        return b % 3 != 0 or (s is not None and (s + b) % 7 != 0)

    assert len(found) == len(set(found)) and {tuple(r) for r in found} == {p for p in positions if kept(*p)}


def test_tasks_of_lines_and_their_orders_follow_the_rows(spark, star, monkeypatch):
    monkeypatch.setattr(readers, "TASK_ROWS", 50)
    monkeypatch.setattr(readers, "LINE_COLUMNS", ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    source = readers.StarSchemaSources(spark, star[0])
    orders = spark.read.parquet(f"{star[0]}/orders.parquet").withColumn("o_orderdate", F.to_date(F.lit("1996-01-01")))
    source._scans["orders"] = orders
    bought = source.table("purchases", "Store", "Brand", "PONumber", "PODate")
    billed = source.table("vendor_invoice", "VendorNumber", "PONumber", "Quantity")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for orders too many to broadcast
    try:
        assert bought.rdd.getNumPartitions() == billed.rdd.getNumPartitions() == 41
        # lines meet their orders and are summed by them where they were dealt, once
        plan = billed._jdf.queryExecution().executedPlan().toString().splitlines()
        moves = [x for x in plan if "Exchange hashpartitioning" in x]
        assert moves and all("REPARTITION_BY_NUM" in x for x in moves)
        assert bought.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
