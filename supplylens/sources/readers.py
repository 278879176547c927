"""Where the six source tables come from.

Every reader answers ``table(name, *columns)``; naming the columns lets the scan, and
for derived tables the joins, be pruned to what the caller needs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SOURCE_COLUMNS


class FrameSources:
    """Source tables given as DataFrames."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = self._frames[name]
        return frame.select(*columns) if columns else frame


class ParquetSources:
    """Source tables as one parquet folder each under a common root."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = self._spark.read.parquet(f"{self._root}/{name}")
        return frame.select(*columns) if columns else frame


def cents(c: Column) -> Column:
    """Round half up to two decimals with floor, which every engine computes alike."""
    return F.floor(c * 100 + 0.5) / 100.0


LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_shipdate",
)
#: Line items that one task joins with their orders, sorts and groups.
TASK_ROWS = 500_000


class StarSchemaSources:
    """Source tables derived from the order / lineitem / part / supplier star schema.

    Each requested column names the dimension tables it needs, and only those are joined.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._scans: dict[str, DataFrame] = {}
        self._dealt = 0

    @cached_property
    def _lines_count(self) -> int:
        return self._read("lineitem").count()  # the files' footers say it

    def _read(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = self._spark.read.parquet(f"{self._root}/{name}.parquet")
        return self._scans[name]

    def table(self, name: str, *columns: str) -> DataFrame:
        return getattr(self, f"_{name}")(columns or tuple(SOURCE_COLUMNS[name]))

    def _vendor_count(self) -> Column:
        return self._read("supplier").agg((F.max("s_suppkey") + 1).alias("n")).scalar()

    def _tasks(self) -> int:
        """Tasks for a pass over all lines: they follow the rows, so what one of them holds does not.

        Shuffles that adaptive execution merges end at so many bytes as compressed, and two such
        columns take some thirty times as much in hash tables and sorts.
        """
        if not self._dealt:
            self._dealt = max(self._spark.sparkContext.defaultParallelism, math.ceil(self._lines_count / TASK_ROWS))
        return self._dealt

    def _deal(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows that are to meet by an order's key; where one task may hold all lines, as they are."""
        return rows.repartition(self._tasks(), *keys) if self._lines_count > TASK_ROWS else rows

    def _lines(self) -> DataFrame:
        """Line items with the vendor assigned to them."""
        vendor = F.when(F.col("l_partkey") % 4 == 0, F.col("l_suppkey")).otherwise(
            F.col("l_partkey") % self._vendor_count()
        )
        return self._read("lineitem").select(*LINE_COLUMNS).withColumn("vendor", vendor)

    def _join_needed(
        self, lines: DataFrame, needed: set[str], vendor: str, dealt: bool = False, together: tuple[str, ...] = ()
    ) -> DataFrame:
        """``dealt``: the lines have been dealt by ``l_orderkey``; ``together``: what they are to be dealt by."""
        if "orders" in needed:
            orders = self._read("orders").select(
                "o_orderkey", "o_custkey", "o_orderstatus",
                F.col("o_orderdate").cast("date").alias("ordered"),
            )
            lines, orders = lines if dealt else self._deal(lines, "l_orderkey"), self._deal(orders, "o_orderkey")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if "part" in needed:
            part = self._read("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        if together:  # while the rows are narrow: names and what is derived come after
            lines = self._deal(lines, *together)
        if "supplier" in needed:
            supplier = self._read("supplier").select("s_suppkey", "s_name")
            lines = lines.join(supplier, F.col(vendor) == F.col("s_suppkey"))
        return lines

    def _project(
        self, lines: DataFrame, specs: dict[str, tuple[Column, str]], columns, vendor: str, number: str = ""
    ) -> DataFrame:
        """``number``: what an order's number is taken from; rows with it and the vendor's come dealt by both,
        so that grouping or joining them by order moves no row again."""
        needed = {w for c in columns for w in specs[c][1].split()}
        together = (vendor, number) if number and {"VendorNumber", "PONumber"} <= set(columns) else ()
        joined = self._join_needed(lines, needed, vendor, together=together)
        return joined.select(*[specs[c][0].alias(c) for c in columns])

    @staticmethod
    def _vendor_name() -> Column:
        variant = (F.col("vendor") % 50 == 3) & (F.col("l_partkey") % 2 == 0)
        return F.concat(
            F.col("s_name"),
            F.when(variant, " LLC").otherwise(""),
            F.when(F.col("l_orderkey") % 7 == 0, "  ").otherwise(""),
        )

    def _purchases(self, columns) -> DataFrame:
        o, p = F.col("l_orderkey"), F.col("l_partkey")
        days = 3 + (o * 7 + F.col("l_linenumber") * 3) % 12
        days = days + F.when(o % 41 == 0, 60).when(o % 29 == 0, 20).when(o % 23 == 0, 40).otherwise(0)
        late = F.when((o % 97 == 0) & (F.col("l_linenumber") % 2 == 1), 1).otherwise(0)
        ordered = F.col("ordered")
        unit = cents(F.col("l_extendedprice") / F.col("l_quantity"))
        specs = {
            "InventoryId": (
                F.concat_ws("_", F.col("o_custkey") % 80 + 1, p, F.col("p_size")), "orders part"
            ),
            "Store": (F.col("o_custkey") % 80 + 1, "orders"),
            "Brand": (p, ""),
            "Description": (F.col("p_name"), "part"),
            "Size": (F.concat(F.col("p_size").cast("string"), F.lit("mL")), "part"),
            "VendorNumber": (F.col("vendor"), ""),
            "VendorName": (self._vendor_name(), "supplier"),
            "PONumber": (o, ""),
            "PODate": (F.date_add(ordered, late), "orders"),
            "ReceivingDate": (
                F.when(o % 53 != 0, F.date_add(ordered, days.cast("int"))), "orders"
            ),
            "InvoiceDate": (F.date_add(ordered, 20), "orders"),
            "PayDate": (F.date_add(ordered, 50), "orders"),
            "PurchasePrice": (F.when(p % 19 == 0, 0.0).otherwise(unit), ""),
            "Quantity": (F.col("l_quantity").cast("bigint"), ""),
            "Dollars": (F.col("l_extendedprice"), ""),
            "Classification": ((F.col("p_size") % 2 + 1).cast("bigint"), "part"),
        }
        return self._project(self._lines(), specs, columns, "vendor", "l_orderkey")

    def _sales(self, columns) -> DataFrame:
        p = F.col("l_partkey")
        seller = F.when(p % 11 == 0, (F.col("vendor") + 1) % self._vendor_count()).otherwise(
            F.col("vendor")
        )
        lines = self._lines().where(F.col("l_returnflag") != "R").withColumn("seller", seller)
        quantity = F.col("l_quantity").cast("bigint")
        dollars = cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))
        specs = {
            "InventoryId": (
                F.concat_ws("_", F.col("o_custkey") % 80 + 1, p, F.col("p_size")), "orders part"
            ),
            "Store": (F.col("o_custkey") % 80 + 1, "orders"),
            "Brand": (p, ""),
            "Description": (F.col("p_name"), "part"),
            "Size": (F.concat(F.col("p_size").cast("string"), F.lit("mL")), "part"),
            "SalesQuantity": (quantity, ""),
            "SalesDollars": (dollars, ""),
            "SalesPrice": (cents(dollars / quantity), ""),
            "SalesDate": (F.col("l_shipdate").cast("date"), ""),
            "Volume": ((F.col("p_size") * 10).cast("double"), "part"),
            "Classification": ((F.col("p_size") % 2 + 1).cast("bigint"), "part"),
            "ExciseTax": (cents(F.col("l_extendedprice") * F.col("l_tax")), ""),
            "VendorNo": (F.col("seller"), ""),
            "VendorName": (F.col("s_name"), "supplier"),
        }
        return self._project(lines, specs, columns, "seller")

    def _purchase_prices(self, columns) -> DataFrame:
        keys = self._lines().select("vendor", "l_partkey").distinct()
        copies = F.explode(
            F.when(F.col("l_partkey") % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
                F.array(F.lit(0))
            )
        )
        p = F.col("l_partkey")
        specs = {
            "Brand": (p, ""),
            "Description": (F.col("p_name"), "part"),
            "Price": (F.col("p_retailprice") + F.col("copy"), "part"),
            "Size": (F.concat(F.col("p_size").cast("string"), F.lit("mL")), "part"),
            "Volume": (
                F.when(p % 13 == 0, "Unknown").otherwise((F.col("p_size") * 10).cast("string")),
                "part",
            ),
            "Classification": ((F.col("p_size") % 2 + 1).cast("bigint"), "part"),
            "PurchasePrice": (
                cents(F.col("p_retailprice") * 0.75) + F.col("copy") * 0.5, "part"
            ),
            "VendorNumber": (F.col("vendor"), ""),
            "VendorName": (F.col("s_name"), "supplier"),
        }
        return self._project(keys.withColumn("copy", copies), specs, columns, "vendor")

    def _vendor_invoice(self, columns) -> DataFrame:
        status = F.col("o_orderstatus")
        per_order = self._deal(self._lines(), "l_orderkey").groupBy("vendor", "l_orderkey").agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
            F.sum(F.col("l_extendedprice").cast("decimal(28,4)")).cast("double").alias("d"),
        )
        orders = self._join_needed(per_order, {"orders"}, "vendor", dealt=True).where(
            status.isin("F", "O") | (F.col("l_orderkey") % 5 == 0)
        )
        o = F.col("l_orderkey")
        orders = orders.withColumn("number", o + F.when(status == "P", 10_000_000).otherwise(0))
        specs = {
            "VendorNumber": (F.col("vendor"), ""),
            "VendorName": (F.col("s_name"), "supplier"),
            "InvoiceDate": (F.date_add("ordered", 20), ""),
            "PONumber": (F.col("number"), ""),
            "PODate": (F.col("ordered"), ""),
            "PayDate": (F.date_add("ordered", 50), ""),
            "Quantity": (F.col("q") + F.when(o % 31 == 0, 1).when(o % 43 == 0, -1).otherwise(0), ""),
            "Dollars": (F.col("d") - F.when(o % 37 == 0, 5.0).otherwise(0.0), ""),
            "Freight": (cents(F.col("d") * 0.005), ""),
            "Approval": (F.lit(None).cast("string"), ""),
        }
        return self._project(orders, specs, columns, "vendor", "number")

    def _snapshot(self, columns, on_hand: Column, keep: Column, day: str, date: str) -> DataFrame:
        tasks = self._tasks()
        lines = self._read("lineitem").select("l_orderkey", "l_partkey").repartition(tasks, "l_orderkey")
        orders = self._read("orders").select("o_orderkey", "o_custkey").repartition(tasks, "o_orderkey")
        positions = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select((F.col("o_custkey") % 80 + 1).alias("store"), "l_partkey")
            .repartition(tasks, "store", "l_partkey")
            .distinct()
            .where(keep)
        )
        specs = {
            "InventoryId": (F.concat_ws("_", F.col("store"), F.col("l_partkey")), ""),
            "Store": (F.col("store"), ""),
            "City": (F.concat(F.lit("CITY"), F.col("store").cast("string")), ""),
            "Brand": (F.col("l_partkey"), ""),
            "Description": (F.col("p_name"), "part"),
            "Size": (F.concat(F.col("p_size").cast("string"), F.lit("mL")), "part"),
            "onHand": (on_hand, ""),
            "Price": (F.col("p_retailprice"), "part"),
            day: (F.lit(date).cast("date"), ""),
        }
        return self._project(positions, specs, columns, "")

    def _begin_inventory(self, columns) -> DataFrame:
        s, b = F.col("store"), F.col("l_partkey")
        keep = ~((b % 3 == 0) & ((s + b) % 7 == 0))
        return self._snapshot(columns, (s * 13 + b * 7) % 50, keep, "startDate", "1996-01-01")

    def _end_inventory(self, columns) -> DataFrame:
        s, b = F.col("store"), F.col("l_partkey")
        keep = ~((b % 5 == 0) & ((s + b) % 6 == 0))
        return self._snapshot(columns, (s * 11 + b * 3) % 40, keep, "endDate", "1996-12-31")
