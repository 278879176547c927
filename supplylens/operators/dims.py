"""Dimensions, the monthly spend fact and the star-schema check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import FINE, money, trim_spaces
from ..functions.workspace import hold

MONTHLY_COLUMNS = (
    "VendorNumber", "VendorName", "Brand", "Description", "PODate", "PONumber", "Quantity",
    "Dollars", "PurchasePrice",
)


def dim_supplier(purchases: DataFrame) -> DataFrame:
    """Suppliers with distinct brand and order counts and their totals.

    Orders and brands are grouped from the lines each on their own, the brands from two columns of
    them, so that what is shuffled are these groups and not nearly every line; nothing is expanded
    and no raw line is sorted.
    """
    orders = (
        purchases.groupBy("VendorNumber", "PONumber", trim_spaces("VendorName").alias("VendorName"))
        .agg(F.sum("Quantity").alias("q"), F.sum(money("Dollars")).alias("d"))
        .groupBy("VendorNumber", "PONumber")
        .agg(F.max("VendorName").alias("VendorName"), F.sum("q").alias("q"), F.sum("d").alias("d"))
        .groupBy("VendorNumber")
        .agg(
            F.max("VendorName").alias("VendorName"), F.sum("q").alias("q"), F.sum("d").alias("d"),
            F.count("PONumber").alias("PurchaseOrderCount"),
        )
    )
    brands = (
        purchases.groupBy("VendorNumber", "Brand")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("VendorNumber")
        .agg(F.count("Brand").alias("BrandCount"))
    )
    both = orders.unionByName(brands, allowMissingColumns=True)
    return both.groupBy("VendorNumber").agg(
        F.max("VendorName").alias("VendorName"),
        F.max("BrandCount").alias("BrandCount"),
        F.max("PurchaseOrderCount").alias("PurchaseOrderCount"),
        F.max("q").cast("double").alias("PurchaseQuantity"),
        F.max("d").cast("double").alias("PurchaseSpend"),
    )


def dim_brand(purchases: DataFrame) -> DataFrame:
    """Brands with their description, size, class and number of purchasing vendors."""
    variants = purchases.groupBy(
        "Brand",
        "VendorNumber",
        trim_spaces("Description").alias("Description"),
        trim_spaces("Size").alias("Size"),
    ).agg(F.max("Classification").alias("Classification"))
    return variants.groupBy("Brand").agg(
        F.max("Description").alias("Description"),
        F.max("Size").alias("Size"),
        F.max("Classification").alias("Classification"),
        F.count_distinct("VendorNumber").alias("PurchasingVendorCount"),
    )


def dim_store(begin: DataFrame, end: DataFrame, purchases: DataFrame) -> DataFrame:
    """Stores of any source; purchases know no city."""
    places = (
        begin.select("Store", "City")
        .unionByName(end.select("Store", "City"))
        .unionByName(purchases.select("Store"), allowMissingColumns=True)
    )
    return (
        places.groupBy("Store", trim_spaces("City").alias("City"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("Store")
        .agg(F.max("City").alias("City"), F.sum("n").alias("n"))
        .where("n > 0")  # always so; without a use the inner grouping would be optimised away
        .drop("n")
    )


def date_bounds(purchases: DataFrame, sales: DataFrame, invoices: DataFrame) -> DataFrame:
    """First and last day over four date columns, one pass per table."""
    parts = [
        purchases.agg(
            F.least(F.min("PODate"), F.min("ReceivingDate")).alias("lo"),
            F.greatest(F.max("PODate"), F.max("ReceivingDate")).alias("hi"),
        ),
        sales.agg(F.min("SalesDate").alias("lo"), F.max("SalesDate").alias("hi")),
        invoices.agg(F.min("InvoiceDate").alias("lo"), F.max("InvoiceDate").alias("hi")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """Every calendar day between the bounds; empty when there are no dates."""
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("FullDate")
    )
    d = F.col("FullDate")
    return days.select(
        "FullDate",
        F.date_format(d, "yyyyMMdd").cast("int").alias("DateKey"),
        F.year(d).alias("Year"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMM").alias("MonthName"),
        F.date_format(d, "yyyy-MM").alias("YearMonth"),
        F.quarter(d).alias("Quarter"),
    )


def procurement_monthly(purchases: DataFrame) -> DataFrame:
    """Spend per vendor, brand and month of order; the price is an unweighted mean."""
    dated = purchases.where(F.col("PODate").isNotNull())
    keys = ["VendorNumber", "Brand", "SpendMonth"]
    orders = dated.groupBy(
        "VendorNumber", "Brand", F.trunc("PODate", "MM").alias("SpendMonth"), "PONumber",
        trim_spaces("VendorName").alias("VendorName"), trim_spaces("Description").alias("Description"),
    ).agg(
        F.sum("Quantity").alias("q"),
        F.sum(money("Dollars")).alias("d"),
        F.sum(F.col("PurchasePrice").cast(FINE)).alias("p"),
        F.count("PurchasePrice").alias("n"),
    )
    return orders.groupBy(*keys).agg(
        F.max("VendorName").alias("VendorName"),
        F.max("Description").alias("Description"),
        F.count_distinct("PONumber").alias("PurchaseOrderCount"),
        F.sum("q").cast("double").alias("PurchaseQuantity"),
        F.sum("d").cast("double").alias("PurchaseSpend"),
        F.try_divide(F.sum("p").cast("double"), F.sum("n").cast("double")).alias(
            "AveragePurchasePrice"
        ),
    ).select(
        "VendorNumber", "VendorName", "Brand", "Description", "SpendMonth", "PurchaseOrderCount",
        "PurchaseQuantity", "PurchaseSpend", "AveragePurchasePrice",
    )


# The model's relationships, dimension (one) to fact (many).
RELATIONSHIPS = (
    ("dim_supplier", "VendorNumber", "fact_purchase_order", "VendorNumber"),
    ("dim_supplier", "VendorNumber", "fact_supplier_performance", "VendorNumber"),
    ("dim_brand", "Brand", "fact_procurement_monthly", "Brand"),
    ("dim_store", "Store", "fact_inventory_summary", "Store"),
    ("dim_date", "FullDate", "fact_purchase_order", "PODate"),
)


def relationship_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per relationship: fact rows, and fact rows whose key the dimension lacks.

    Fact keys are counted first, so a hot key is one row in the join. The keys of each dimension and the row
    of each relationship are written by themselves, so the shuffles of one of them lie on disk at a time.
    """
    known = {
        dim: hold(tables[dim].select(F.col(key).alias("k"), F.lit(1).alias("known")), f"{dim}_keys")
        for dim, key in dict.fromkeys((dim, key) for dim, key, _, _ in RELATIONSHIPS)
    }
    out = None
    for dim, dim_key, fact, fact_key in RELATIONSHIPS:
        keys = tables[fact].groupBy(F.col(fact_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        row = keys.join(known[dim], "k", "left").agg(
            F.lit(f"{dim}.{dim_key} -> {fact}.{fact_key}").alias("Relationship"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("FactRows"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("OrphanRows"),
        )
        part = hold(row, "relationship")
        out = part if out is None else out.unionByName(part)
    return out
