"""Vendor-brand summary: purchases, sales, reference prices, freight and inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money, ratio, single_value, strip_whitespace, trim_spaces
from ..functions.frames import aggregate_with_labels
from ..functions.workspace import hold_together

PURCHASE_COLUMNS = (
    "VendorNumber", "Brand", "VendorName", "Description", "Quantity", "Dollars",
    "PurchasePrice",
)
SALES_COLUMNS = (
    "VendorNo", "Brand", "VendorName", "Description", "SalesDollars", "SalesQuantity",
    "ExciseTax", "SalesPrice",
)
PRICE_COLUMNS = ("VendorNumber", "Brand", "Price", "PurchasePrice", "Volume")
KEYS = ["VendorNumber", "Brand"]


def purchase_summary(purchases: DataFrame) -> DataFrame:
    """Per vendor and brand: totals and the price weighted over rows with a usable cost."""
    costed = (F.col("PurchasePrice") > 0) & (F.col("Quantity") > 0)
    return aggregate_with_labels(
        purchases,
        KEYS,
        labels={
            "VendorName": trim_spaces("VendorName"),
            "Description": trim_spaces("Description"),
        },
        first={
            "q": F.sum("Quantity"),
            "d": F.sum(money("Dollars")),
            "c": F.sum(F.when(costed, F.col("Quantity") * money("PurchasePrice"))),
            "cq": F.sum(F.when(costed, F.col("Quantity"))),
        },
        last={
            "TotalPurchaseQuantity": F.sum("q").cast("double"),
            "TotalPurchaseDollars": F.sum("d").cast("double"),
            "PurchasePrice": F.try_divide(F.sum("c").cast("double"), F.sum("cq").cast("double")),
            "CostCoveredPurchaseQuantity": F.sum("cq").cast("double"),
        },
    )


def price_summary(prices: DataFrame) -> DataFrame:
    """Per vendor and brand: the reference prices where they agree, and the largest volume."""
    return prices.groupBy(*KEYS).agg(
        single_value("Price").alias("ActualPrice"),
        single_value("PurchasePrice").alias("ReferencePurchasePrice"),
        F.max(F.col("Volume").try_cast("double")).alias("Volume"),
    )


def sales_summary(sales: DataFrame) -> DataFrame:
    """Per vendor and brand: totals and the quantity-weighted sales price."""
    return aggregate_with_labels(
        sales,
        ["VendorNo", "Brand"],
        labels={
            "VendorName": trim_spaces("VendorName"),
            "Description": trim_spaces("Description"),
        },
        first={
            "d": F.sum(money("SalesDollars")),
            "q": F.sum("SalesQuantity"),
            "x": F.sum(money("ExciseTax")),
            "v": F.sum(money("SalesPrice") * F.col("SalesQuantity")),
        },
        last={
            "TotalSalesDollars": F.sum("d").cast("double"),
            "TotalSalesQuantity": F.sum("q").cast("double"),
            "TotalExciseTax": F.sum("x").cast("double"),
            "TotalSalesPrice": F.try_divide(F.sum("v").cast("double"), F.sum("q").cast("double")),
        },
    )


def freight_by_vendor(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("VendorNumber").agg(
        F.sum(money("Freight")).cast("double").alias("VendorFreight")
    )


def spend_by_vendor(purchased: DataFrame) -> DataFrame:
    """Vendor totals from the vendor-brand purchase summary."""
    return purchased.groupBy("VendorNumber").agg(
        F.sum(money("TotalPurchaseDollars")).cast("double").alias("VendorPurchaseDollars")
    )


def vendors_per_brand(purchased: DataFrame) -> DataFrame:
    """Distinct purchasing vendors of each brand; the input has one row per pair."""
    return purchased.groupBy("Brand").agg(F.count("VendorNumber").alias("VendorCount"))


def freight_allocation(purchased: DataFrame, invoices: DataFrame) -> DataFrame:
    """Vendor freight spread over the vendor's brands by their share of its spend."""
    vendor = spend_by_vendor(purchased).join(freight_by_vendor(invoices), "VendorNumber", "left")
    return purchased.join(vendor, "VendorNumber").select(
        *KEYS,
        "TotalPurchaseDollars",
        "VendorPurchaseDollars",
        "VendorFreight",
        _allocated("TotalPurchaseDollars").alias("FreightCost"),
    )


def _allocated(dollars: str) -> Column:
    return ratio(F.col("VendorFreight") * F.col(dollars), "VendorPurchaseDollars")


def _keys_with_null(purchased: DataFrame, sold: DataFrame) -> DataFrame:
    """Distinct keys with a NULL part: they are kept, but match neither side."""
    partial = F.col("VendorNumber").isNull() | F.col("Brand").isNull()
    return (
        purchased.select(*KEYS)
        .where(partial)
        .unionByName(sold.select(*KEYS).where(partial))
        .distinct()
    )


def vendor_brand_keys(purchased: DataFrame, sold: DataFrame) -> DataFrame:
    """Distinct vendor-brand keys of either side."""
    return (
        purchased.select(*KEYS)
        .unionByName(sold.select(F.col("VendorNo").alias("VendorNumber"), "Brand"))
        .distinct()
    )


def vendor_sales_summary(
    purchases: DataFrame,
    sales: DataFrame,
    prices: DataFrame,
    invoices: DataFrame,
    brand_inventory: DataFrame,
) -> DataFrame:
    """One row per vendor and brand seen in purchases or sales.

    Purchases and sales are aggregated on the join key, meet their reference prices there and each other
    by one full outer join, which needs no further shuffle. Keys with a NULL part never match anything and
    are added once each. Vendor money and brand facts are each collected into one table; only purchases
    use them, so these are joined once by vendor and once by brand while they are narrow.
    """
    sides = hold_together(
        {
            "purchase_summary": purchase_summary(purchases),
            "sales_summary": sales_summary(sales).withColumnRenamed("VendorNo", "VendorNumber"),
        }
    )
    p, s = sides["purchase_summary"], sides["sales_summary"]
    whole = F.col("VendorNumber").isNotNull() & F.col("Brand").isNotNull()
    vendor = spend_by_vendor(p).join(freight_by_vendor(invoices), "VendorNumber", "left")
    brand = brand_inventory.select(
        "Brand",
        F.col("AverageInventoryUnits").alias("brand_avg"),
        F.col("EndingInventoryUnits").alias("brand_end"),
        F.col("EndingInventoryRetailValue").alias("brand_value"),
        (F.col("StoreCount") == F.col("CompleteStoreCount")).alias("complete"),
    ).join(vendors_per_brand(p), "Brand")
    price = price_summary(prices)
    facts = ("VendorPurchaseDollars", "VendorFreight", "brand_avg", "brand_end", "brand_value", "complete", "VendorCount")

    bought = p.where(whole).join(vendor, "VendorNumber", "left").join(brand, "Brand", "left").join(price, KEYS, "left")
    sold = s.where(whole).join(price, KEYS, "left")
    paired = bought.alias("p").join(
        sold.alias("s"),
        (F.col("p.VendorNumber") == F.col("s.VendorNumber"))
        & (F.col("p.Brand") == F.col("s.Brand")),
        "full",
    ).select(
        F.coalesce("p.VendorNumber", "s.VendorNumber").alias("VendorNumber"),
        F.coalesce("p.VendorName", "s.VendorName").alias("VendorName"),
        F.coalesce("p.Brand", "s.Brand").alias("Brand"),
        F.coalesce("p.Description", "s.Description").alias("Description"),
        "PurchasePrice",
        *[F.coalesce(f"p.{c}", f"s.{c}").alias(c) for c in ("ActualPrice", "ReferencePurchasePrice", "Volume")],
        F.col("TotalPurchaseQuantity").alias("pq"),
        "CostCoveredPurchaseQuantity",
        F.col("p.TotalPurchaseDollars").alias("pd"),
        F.col("TotalSalesDollars").alias("sd"),
        "TotalSalesPrice",
        F.col("TotalSalesQuantity").alias("sq"),
        F.col("TotalExciseTax").alias("tax"),
        F.col("p.VendorNumber").isNotNull().alias("purchased"),
        *facts,
    )
    joined = paired.unionByName(_keys_with_null(p, s), allowMissingColumns=True).withColumn(
        "eligible", F.col("purchased") & (F.col("VendorCount") == 1) & F.col("complete")
    )
    known_cost = F.col("PurchasePrice").isNotNull()
    costed_sales = known_cost & (F.col("pq") > 0) & (F.col("sq") > 0)
    uncosted = F.col("PurchasePrice").isNull() | (F.col("pq") <= 0) | (F.col("sq") <= 0)

    def if_eligible(c):
        return F.when(F.col("eligible"), c)

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0.0))

    summary = joined.select(
        "VendorNumber",
        strip_whitespace("VendorName").alias("VendorName"),
        "Brand",
        strip_whitespace("Description").alias("Description"),
        "PurchasePrice",
        "ActualPrice",
        "Volume",
        zero("pq").alias("TotalPurchaseQuantity"),
        "CostCoveredPurchaseQuantity",
        zero("pd").alias("TotalPurchaseDollars"),
        zero("sd").alias("TotalSalesDollars"),
        "TotalSalesPrice",
        zero("sq").alias("TotalSalesQuantity"),
        zero("tax").alias("TotalExciseTax"),
        _allocated("pd").alias("FreightCost"),
        "ReferencePurchasePrice",
        (F.col("PurchasePrice") - F.col("ReferencePurchasePrice")).alias("PurchasePriceVariance"),
        if_eligible(F.col("brand_avg")).alias("AverageInventoryUnits"),
        if_eligible(F.col("brand_end")).alias("EndingInventoryUnits"),
        if_eligible(F.col("brand_value")).alias("EndingInventoryRetailValue"),
        if_eligible(ratio("sq", "brand_avg")).alias("StockTurnover"),
        if_eligible(F.col("brand_end") * F.col("PurchasePrice")).alias("Unsold Capital"),
        F.when(costed_sales, F.col("sd")).alias("CostCoveredSalesDollars"),
        F.coalesce(F.when(uncosted, F.col("sd")), F.lit(0.0)).alias("UncostedSalesDollars"),
    )
    return add_profit_metrics(summary)


def add_profit_metrics(summary: DataFrame) -> DataFrame:
    """Estimated gross profit, margin, sales-to-purchase ratio and price variance."""
    costed = F.col("PurchasePrice").isNotNull() & (F.col("CostCoveredPurchaseQuantity") > 0)
    profit = F.when(
        costed & F.col("TotalSalesDollars").isNotNull() & (F.col("TotalSalesQuantity") > 0),
        F.col("TotalSalesDollars") - F.col("TotalSalesQuantity") * F.col("PurchasePrice"),
    )
    return summary.withColumn("GrossProfit", profit).select(
        "*",
        ratio("GrossProfit", "CostCoveredSalesDollars", 100.0).alias("ProfitMargin"),
        ratio("TotalSalesDollars", "TotalPurchaseDollars").alias("SalesToPurchaseRatio"),
        ratio("PurchasePriceVariance", "ReferencePurchasePrice", 100.0).alias(
            "PurchasePriceVariancePct"
        ),
    )
