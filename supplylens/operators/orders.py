"""Purchase orders against invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import (
    aging_bucket,
    aging_bucket_open,
    holds,
    money,
    ratio,
    trim_spaces,
)
from ..functions.frames import aggregate_with_labels

KEYS = ["VendorNumber", "PONumber"]

# Status and flag labels, notes.
INVOICE_ONLY, PURCHASE_ONLY, MATCHED = "Invoice only", "Purchase only", "Matched"
NOT_MATCHED, UNKNOWN = "Not matched", "Unknown"
QUANTITY_FLAGS = (
    "Quantity aligned", "Invoice qty below purchase qty", "Invoice qty above purchase qty"
)
DOLLAR_FLAGS = (
    "Dollars aligned",
    "Invoice dollars below purchase dollars",
    "Invoice dollars above purchase dollars",
)
DELIVERY_BASIS = (
    "Observed lead time + invoice reconciliation "
    "(true OTIF unsupported: no promised date / ordered qty)"
)
DELIVERY_LABEL = "Invoice reconciliation performance (not OTIF)"
AGING_BASIS = (
    "Observed PO cycle time = LastReceivingDate - PODate "
    "(completed receipts only; not open-order aging)"
)

PURCHASE_COLUMNS = (
    "VendorNumber", "PONumber", "VendorName", "PODate", "ReceivingDate", "InvoiceDate",
    "PayDate", "Quantity", "Dollars",
)
INVOICE_COLUMNS = (
    "VendorNumber", "PONumber", "VendorName", "PODate", "InvoiceDate", "PayDate", "Quantity",
    "Dollars", "Freight",
)


def _observed_days(first_po: Column, last_po: Column, receipt: Column) -> Column:
    """Days from order to last receipt when the order carries one single PO date."""
    return F.when((first_po == last_po) & receipt.isNotNull(), F.datediff(receipt, first_po))


def purchase_orders(purchases: DataFrame) -> DataFrame:
    """One row per vendor and PO number on the purchase side.

    The lines are combined by hash; only the few spellings of an order's vendor are sorted, and
    that order is the one the full outer join with the invoices needs.
    """
    return aggregate_with_labels(
        purchases,
        KEYS,
        {"VendorName": trim_spaces("VendorName")},
        {
            "lo": F.min("PODate"), "hi": F.max("PODate"), "r1": F.min("ReceivingDate"),
            "r2": F.max("ReceivingDate"), "inv": F.min("InvoiceDate"), "pay": F.min("PayDate"),
            "q": F.sum("Quantity"), "d": F.sum(money("Dollars")), "n": F.count(F.lit(1)),
        },
        {
            "PODate": F.min("lo"),
            "LastPODate": F.max("hi"),
            "FirstReceivingDate": F.min("r1"),
            "LastReceivingDate": F.max("r2"),
            "InvoiceDate": F.min("inv"),
            "PayDate": F.min("pay"),
            "PurchaseQuantity": F.sum("q").cast("double"),
            "PurchaseDollars": F.sum("d").cast("double"),
            "PurchaseLineCount": F.sum("n"),
        },
    ).withColumn(
        "ObservedLeadTimeDays",
        _observed_days(F.col("PODate"), F.col("LastPODate"), F.col("LastReceivingDate")),
    ).drop("LastPODate")


def invoice_orders(invoices: DataFrame) -> DataFrame:
    """One row per vendor and PO number on the invoice side."""
    return aggregate_with_labels(
        invoices,
        KEYS,
        {"InvoiceVendorName": trim_spaces("VendorName")},
        {
            "po": F.min("PODate"), "inv": F.min("InvoiceDate"), "pay": F.min("PayDate"),
            "q": F.sum("Quantity"), "d": F.sum(money("Dollars")), "f": F.sum(money("Freight")),
        },
        {
            "InvoicePODate": F.min("po"),
            "InvoiceDate": F.min("inv"),
            "InvoicePayDate": F.min("pay"),
            "InvoiceQuantity": F.sum("q").cast("double"),
            "InvoiceDollars": F.sum("d").cast("double"),
            "Freight": F.sum("f").cast("double"),
        },
    )


def purchase_order_summary(purchases: DataFrame, invoices: DataFrame) -> DataFrame:
    """Every vendor-PO key of either side, with its match status and variances.

    Both sides are aggregated on the join key, so the full outer join adds no shuffle.
    """
    p, i = purchase_orders(purchases).alias("p"), invoice_orders(invoices).alias("i")
    joined = p.join(
        i,
        (F.col("p.VendorNumber") == F.col("i.VendorNumber"))
        & (F.col("p.PONumber") == F.col("i.PONumber")),
        "full",
    )
    on_purchase, on_invoice = F.col("p.PONumber").isNotNull(), F.col("i.PONumber").isNotNull()

    def either(left: str, right: str) -> Column:
        return F.coalesce(F.col(f"p.{left}"), F.col(f"i.{right}"))

    return joined.select(
        either("VendorNumber", "VendorNumber").alias("VendorNumber"),
        either("PONumber", "PONumber").alias("PONumber"),
        either("VendorName", "InvoiceVendorName").alias("VendorName"),
        either("PODate", "InvoicePODate").alias("PODate"),
        "p.FirstReceivingDate",
        "p.LastReceivingDate",
        either("InvoiceDate", "InvoiceDate").alias("InvoiceDate"),
        either("PayDate", "InvoicePayDate").alias("PayDate"),
        "p.PurchaseQuantity",
        "p.PurchaseDollars",
        "p.PurchaseLineCount",
        "p.ObservedLeadTimeDays",
        "i.InvoiceQuantity",
        "i.InvoiceDollars",
        "i.Freight",
        F.when(~on_purchase, INVOICE_ONLY)
        .when(~on_invoice, PURCHASE_ONLY)
        .otherwise(MATCHED)
        .alias("PurchaseOrderMatchStatus"),
        F.when(
            on_purchase & on_invoice, F.col("i.InvoiceQuantity") - F.col("p.PurchaseQuantity")
        ).alias("InvoiceQuantityVariance"),
        F.when(
            on_purchase & on_invoice,
            (money("i.InvoiceDollars") - money("p.PurchaseDollars")).cast("double"),
        ).alias("InvoiceDollarsVariance"),
    )


def _reconciliation_flag(variance: str, tolerance: float, labels: tuple[str, str, str]) -> Column:
    aligned, below, above = labels
    v = F.col(variance)
    return (
        F.when(~F.col("PurchaseOrderMatchStatus").eqNullSafe(F.lit(MATCHED)), NOT_MATCHED)
        .when(v.isNull(), UNKNOWN)
        .when(F.abs(v) < tolerance, aligned)
        .when(v < 0, below)
        .otherwise(above)
    )


def enhance_purchase_orders(orders: DataFrame) -> DataFrame:
    """Add cycle-time bucket, processing days and reconciliation flags."""
    return orders.select(
        "*",
        aging_bucket("ObservedLeadTimeDays").alias("POCycleAgingBucket"),
        F.datediff("InvoiceDate", "PODate").alias("POToInvoiceDays"),
        F.datediff("InvoiceDate", "LastReceivingDate").alias("ReceiptToInvoiceDays"),
        holds(F.col("PurchaseOrderMatchStatus") == MATCHED).alias("HasInvoiceMatch"),
        _reconciliation_flag("InvoiceQuantityVariance", 1e-9, QUANTITY_FLAGS).alias(
            "QuantityReconciliationFlag"
        ),
        _reconciliation_flag("InvoiceDollarsVariance", 0.01, DOLLAR_FLAGS).alias(
            "DollarReconciliationFlag"
        ),
        F.lit(DELIVERY_BASIS).alias("DeliveryMetricBasis"),
    )


def delivery_reconciliation(orders: DataFrame) -> DataFrame:
    """Invoice reconciliation per supplier name: counts, money and rates."""

    def tally(column: str, *labels: str) -> Column:
        return F.count_if(F.col(column).isin(*labels))

    status = "PurchaseOrderMatchStatus"
    grouped = orders.groupBy("VendorNumber", "VendorName").agg(
        F.count("PONumber").alias("PurchaseOrderKeyCount"),
        F.count("PurchaseQuantity").alias("PurchaseSidePOCount"),
        tally(status, MATCHED).alias("MatchedPOCount"),
        tally(status, PURCHASE_ONLY).alias("PurchaseOnlyPOCount"),
        tally(status, INVOICE_ONLY).alias("InvoiceOnlyPOCount"),
        F.coalesce(F.sum(money("PurchaseDollars")).cast("double"), F.lit(0.0)).alias("PurchaseSpend"),
        F.coalesce(F.sum(money("InvoiceDollars")).cast("double"), F.lit(0.0)).alias("InvoiceSpend"),
        F.coalesce(F.sum(money("Freight")).cast("double"), F.lit(0.0)).alias("FreightSpend"),
        tally("QuantityReconciliationFlag", QUANTITY_FLAGS[0]).alias("QuantityAlignedPOCount"),
        tally("QuantityReconciliationFlag", *QUANTITY_FLAGS[1:]).alias("QuantityDiscrepancyPOCount"),
        tally("DollarReconciliationFlag", DOLLAR_FLAGS[0]).alias("DollarAlignedPOCount"),
        tally("DollarReconciliationFlag", *DOLLAR_FLAGS[1:]).alias("DollarDiscrepancyPOCount"),
    )
    return grouped.select(
        "*",
        ratio("MatchedPOCount", "PurchaseOrderKeyCount", 100.0).alias("InvoiceMatchRatePct"),
        ratio("QuantityAlignedPOCount", "MatchedPOCount", 100.0).alias("QuantityAlignmentRatePct"),
        ratio("DollarAlignedPOCount", "MatchedPOCount", 100.0).alias("DollarAlignmentRatePct"),
        F.lit(False).alias("OTIFSupported"),
        F.lit(DELIVERY_LABEL).alias("DeliveryMetricLabel"),
    )


def po_cycle_aging(orders: DataFrame) -> DataFrame:
    """Observed orders by cycle-time bucket, with each bucket's share of all of them."""
    observed = orders.where(F.col("ObservedLeadTimeDays").isNotNull())
    buckets = observed.groupBy("POCycleAgingBucket").agg(
        F.count("PONumber").alias("POCount"),
        F.coalesce(F.sum(money("PurchaseDollars")).cast("double"), F.lit(0.0)).alias("PurchaseSpend"),
        (F.sum("ObservedLeadTimeDays") / F.count("ObservedLeadTimeDays")).alias("AverageLeadTimeDays"),
    )
    everything = W.partitionBy(F.lit(0))  # over the handful of bucket rows
    return buckets.withColumn("_all", F.sum("POCount").over(everything)).select(
        "POCycleAgingBucket",
        "POCount",
        "PurchaseSpend",
        "AverageLeadTimeDays",
        ratio("POCount", "_all", 100.0).alias("ShareOfObservedPOsPct"),
        F.lit(AGING_BASIS).alias("AgingBasis"),
    )


def order_lead_time_view(purchases: DataFrame) -> DataFrame:
    """The warehouse view of lead times per vendor and PO, under its own names."""
    return (
        purchases.groupBy(*KEYS)
        .agg(
            F.min("PODate").alias("PO_DATE"),
            F.max("PODate").alias("_last"),
            F.max("ReceivingDate").alias("LAST_RECEIVING_DATE"),
            F.sum("Quantity").cast("double").alias("PURCHASE_QUANTITY"),
            F.sum(money("Dollars")).cast("double").alias("PURCHASE_DOLLARS"),
        )
        .select(
            F.col("VendorNumber").alias("VENDOR_NUMBER"),
            F.col("PONumber").alias("PO_NUMBER"),
            "PO_DATE",
            "LAST_RECEIVING_DATE",
            "PURCHASE_QUANTITY",
            "PURCHASE_DOLLARS",
            _observed_days(F.col("PO_DATE"), F.col("_last"), F.col("LAST_RECEIVING_DATE")).alias(
                "OBSERVED_LEAD_TIME_DAYS"
            ),
        )
    )


def order_aging_view(view: DataFrame) -> DataFrame:
    """The warehouse view of aging buckets, where negative durations count as the first."""
    return view.withColumn("PO_CYCLE_AGING_BUCKET", aging_bucket_open("OBSERVED_LEAD_TIME_DAYS"))
