"""Chart-ready tables cut from the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import AGING_LABELS, money
from .leadtime import DAYS
from .orders import INVOICE_ONLY, MATCHED, PURCHASE_ONLY

# Columns of the top-supplier table.
TOP_SUPPLIER_COLUMNS = (
    "VendorNumber", "VendorName", "TotalPurchaseDollars", "TotalPurchaseQuantity",
    "PurchaseContributionPct", "MedianLeadTimeDays", "AverageLeadTimeDays", "LeadTimeStdDevDays",
    "InvoiceMatchRatePct", "QuantityAlignmentRatePct", "DollarAlignmentRatePct",
    "AbsoluteAvgPriceVariancePct", "EstimatedEndingInventoryCost", "PerformanceStatus",
    "PurchaseOrderKeyCount", "MatchedPOCount", "SupplierPerformanceScore",
)


def _money_sum(column: str):
    return F.coalesce(F.sum(money(column)).cast("double"), F.lit(0.0)).alias(column)


def largest(df: DataFrame, n: int, by: list[str], ties: list[str]) -> DataFrame:
    """Top ``n`` rows by descending values; equal values in the order of ``ties``."""
    return df.orderBy(*[F.desc_nulls_last(c) for c in by], *[F.asc(c) for c in ties]).limit(n)


def monthly_spend(monthly: DataFrame) -> DataFrame:
    return (
        monthly.where(F.col("SpendMonth").isNotNull())
        .groupBy(F.date_format("SpendMonth", "yyyy-MM").alias("YearMonth"))
        .agg(_money_sum("PurchaseSpend"), _money_sum("PurchaseQuantity"))
        .orderBy("YearMonth")
    )


def top_suppliers(performance: DataFrame, n: int = 20) -> DataFrame:
    return largest(
        performance.select(*TOP_SUPPLIER_COLUMNS),
        n, ["TotalPurchaseDollars"], ["VendorNumber", "VendorName"],
    )


def brand_spend(monthly: DataFrame, n: int = 25) -> DataFrame:
    brands = monthly.groupBy("Brand", F.col("Description").alias("BrandName")).agg(
        _money_sum("PurchaseSpend")
    )
    return largest(brands, n, ["PurchaseSpend"], ["Brand", "BrandName"])


def lead_time_histogram(detail: DataFrame) -> DataFrame:
    return (
        detail.where(F.col(DAYS).isNotNull())
        .groupBy(F.col(DAYS).cast("int").alias("LeadTimeDays"))
        .agg(F.count(F.lit(1)).alias("POCount"))
        .orderBy("LeadTimeDays")
    )


def lead_time_trend(detail: DataFrame) -> DataFrame:
    """Mean, median and number of observed orders per order month, from day counts."""
    days = (
        detail.where(F.col("PODate").isNotNull())
        .groupBy(F.date_format("PODate", "yyyy-MM").alias("YearMonth"), DAYS)
        .agg(F.count(DAYS).alias("n"))
    )
    total = F.sum(F.col(DAYS).cast("long") * F.col("n"))
    return (
        days.groupBy("YearMonth")
        .agg(
            F.try_divide(total.cast("double"), F.sum("n").cast("double")).alias("AvgLeadTimeDays"),
            F.percentile(DAYS, 0.5, F.col("n")).alias("MedianLeadTimeDays"),
            F.sum("n").alias("POCount"),
        )
        .orderBy("YearMonth")
    )


def aging_buckets(aging: DataFrame) -> DataFrame:
    """The aging summary with a row for every bucket, in bucket order."""
    labels = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(label).alias("POCycleAgingBucket"))
            for i, label in enumerate(AGING_LABELS)
        ]
    )
    spark = aging.sparkSession
    grid = spark.range(1).select(F.explode(labels).alias("l")).select("l.*")
    zero = F.lit(0.0)
    return (
        grid.join(aging, "POCycleAgingBucket", "left")
        .orderBy("pos")
        .select(
            "POCycleAgingBucket",
            F.coalesce("POCount", F.lit(0)).alias("POCount"),
            F.coalesce("PurchaseSpend", zero).alias("PurchaseSpend"),
            F.coalesce("ShareOfObservedPOsPct", zero).alias("ShareOfObservedPOsPct"),
            "AverageLeadTimeDays",
        )
    )


def match_status(orders: DataFrame) -> DataFrame:
    return _value_counts(orders, "PurchaseOrderMatchStatus", "POCount")


def performance_status_counts(performance: DataFrame) -> DataFrame:
    return _value_counts(performance, "PerformanceStatus", "SupplierCount")


def _value_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), column)
    )


def as_metric_rows(one_row: DataFrame) -> DataFrame:
    """Turn the columns of a one-row frame into (Metric, Value) rows."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("Metric"), F.col(c).cast("double").alias("Value"))
            for c in one_row.columns
        ]
    )
    return one_row.select(F.explode(cells).alias("cell")).select("cell.*")


def po_key_metrics(orders: DataFrame) -> DataFrame:
    """Counts of vendor-PO keys: one pass, counted per key before the totals."""
    status = F.col("PurchaseOrderMatchStatus")
    keys = orders.groupBy("VendorNumber", "PONumber").agg(
        F.count("PurchaseQuantity").alias("bought"),
        F.count(DAYS).alias("observed"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(status == MATCHED).alias("matched"),
        F.count_if(status == PURCHASE_ONLY).alias("purchase_only"),
        F.count_if(status == INVOICE_ONLY).alias("invoice_only"),
    )

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0))

    return as_metric_rows(
        keys.agg(
            F.count_if(F.col("bought") > 0).alias("PurchaseSidePOKeys"),
            total("observed").alias("ObservedLeadTimeOrders"),
            total("n").alias("ReconciliationKeysFullOuter"),
            total("matched").alias("MatchedPOKeys"),
            total("purchase_only").alias("PurchaseOnlyKeys"),
            total("invoice_only").alias("InvoiceOnlyKeys"),
        )
    )


def _inventory_totals(inventory: DataFrame, by: str) -> DataFrame:
    return inventory.groupBy(by).agg(
        _money_sum("BeginningUnits"),
        _money_sum("EndingUnits"),
        _money_sum("EndingRetailValue"),
        F.coalesce(F.sum("LowInventoryFlag"), F.lit(0)).cast("double").alias("LowInventoryFlag"),
    )


def store_inventory(inventory: DataFrame, n: int = 30) -> DataFrame:
    return largest(_inventory_totals(inventory, "Store"), n, ["EndingUnits"], ["Store"])


def brand_inventory(inventory: DataFrame, n: int = 30) -> DataFrame:
    return largest(_inventory_totals(inventory, "Brand"), n, ["EndingRetailValue"], ["Brand"])


def planning_risk_top(risk: DataFrame, n: int = 40) -> DataFrame:
    return largest(
        risk, n, ["RiskFlagCount", "TotalPurchaseDollars"], ["VendorNumber", "VendorName"]
    )


def supplier_lead_time_top(lead_times: DataFrame, n: int = 25) -> DataFrame:
    return largest(lead_times, n, ["MedianLeadTimeDays"], ["VendorNumber", "VendorName"])


def inventory_kpis(inventory: DataFrame) -> DataFrame:
    """Portfolio totals and the share of ending positions that are in stock."""
    totals = inventory.agg(
        _money_sum("BeginningUnits"),
        _money_sum("EndingUnits"),
        _money_sum("EndingRetailValue"),
        F.coalesce(F.sum("LowInventoryFlag"), F.lit(0)).alias("LowInventoryFlags"),
        F.try_divide(
            F.coalesce(F.sum("EndingAvailable"), F.lit(0)).cast("double"),
            F.count("EndingUnits").cast("double"),
        ).alias("AvailabilityRate"),
    )
    return as_metric_rows(totals)
