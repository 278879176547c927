"""Dataset audit and portfolio reconciliation, each as one row of metrics.

The audit recomputes its figures from the raw tables, apart from the summary model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money, within
from ..functions.frames import one_row_per, with_scalars
from ..functions.workspace import hold_together
from .leadtime import DAYS, portfolio_lead_times
from .quality import DataQualityError, duplicate_counts, repeat_counts

PURCHASE_COLUMNS = (
    "VendorNumber", "Brand", "PONumber", "PODate", "ReceivingDate", "Quantity", "Dollars",
    "PurchasePrice",
)
SALES_COLUMNS = ("VendorNo", "Brand", "SalesQuantity", "SalesDollars")
PAIR = ["Vendor", "Brand"]


def _pair_measures() -> list[Column]:
    priced = F.col("PurchasePrice").isNotNull()
    return [
        F.count(F.lit(1)).alias("PurchaseRows"),
        F.sum("Quantity").alias("PurchaseQuantity"),
        F.sum(money("Dollars")).alias("PurchaseDollars"),
        F.sum(F.col("Quantity") * money("PurchasePrice")).alias("CostNumerator"),
        F.sum(F.when(priced, F.col("Quantity")).otherwise(0)).alias("CostQuantity"),
    ]


def _date_measures() -> list[Column]:
    return [
        F.min("PODate").alias("PODateMin"),
        F.max("PODate").alias("PODateMax"),
        F.min("ReceivingDate").alias("FirstReceivingDate"),
        F.max("ReceivingDate").alias("LastReceivingDate"),
    ]


def purchase_pairs(purchases: DataFrame) -> DataFrame:
    """Per vendor and brand; a row counts towards the cost when it has a price at all."""
    return purchases.groupBy(F.col("VendorNumber").alias("Vendor"), "Brand").agg(*_pair_measures())


def _sales_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("SalesRows"),
        F.sum("SalesQuantity").alias("SalesQuantity"),
        F.sum(money("SalesDollars")).alias("SalesDollars"),
    ]


def sales_pairs(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.col("VendorNo").alias("Vendor"), "Brand").agg(*_sales_measures())


def purchase_grains(purchases: DataFrame) -> DataFrame:
    """Totals, vendor-brand pairs and orders from one scan; ``Grain`` tells the rows apart.

    A line goes into three groups at once, which are combined before anything is shuffled.
    """
    pair, order = ["VendorNumber", "Brand"], ["VendorNumber", "PONumber"]
    return purchases.groupingSets([pair, order, []], "VendorNumber", "Brand", "PONumber").agg(
        *_pair_measures(), *_date_measures(), _grain("Brand", "PONumber")
    ).withColumnRenamed("VendorNumber", "Vendor")


def sales_grains(sales: DataFrame) -> DataFrame:
    """Totals and vendor-brand pairs from one scan."""
    return sales.groupingSets([["VendorNo", "Brand"], []], "VendorNo", "Brand").agg(
        *_sales_measures(), _grain("Brand")
    ).withColumnRenamed("VendorNo", "Vendor")


def _grain(pair: str, order: str | None = None) -> Column:
    is_order = F.lit(False) if order is None else F.grouping(order) == 0
    return F.when(F.grouping(pair) == 0, "pair").when(is_order, "order").otherwise("all").alias("Grain")


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of every key, NULL parts included."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def combined_pairs(bought: DataFrame, sold: DataFrame) -> DataFrame:
    """Purchases and sales of every pair of either side; each side has a pair once."""
    return one_row_per(bought, PAIR).join(one_row_per(sold, PAIR), PAIR, "full")


def _with_days(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn(
        DAYS,
        F.when(
            F.col("PODateMin") == F.col("PODateMax"),
            F.datediff("LastReceivingDate", "PODateMin"),
        ),
    )


def order_dates(purchases: DataFrame) -> DataFrame:
    """Per vendor and PO: order dates, receipts, and the lead time where both are sound."""
    return _with_days(purchases.groupBy("VendorNumber", "PONumber").agg(*_date_measures()))


def position_coverage(begin: DataFrame, end: DataFrame) -> DataFrame:
    """Distinct store-brand positions with the snapshots they occur in.

    One aggregate over both snapshots replaces building and intersecting two key sets.
    """
    marked = begin.select("Store", "Brand", F.lit(1).alias("b"), F.lit(0).alias("e")).unionByName(
        end.select("Store", "Brand", F.lit(0).alias("b"), F.lit(1).alias("e"))
    )
    return marked.groupBy("Store", "Brand").agg(
        F.sum("b").alias("BeginRows"), F.sum("e").alias("EndRows")
    )


def brand_coverage(positions: DataFrame) -> DataFrame:
    """Per brand: all positions and those present in both snapshots."""
    both = (F.col("BeginRows") > 0) & (F.col("EndRows") > 0)
    return positions.groupBy("Brand").agg(
        F.count(F.lit(1)).alias("AllPositions"), F.count_if(both).alias("CompletePositions")
    )


def brand_vendor_counts(bought: DataFrame) -> DataFrame:
    return bought.groupBy("Brand").agg(F.count("Vendor").alias("Vendors"))


def eligible_brands(coverage: DataFrame, vendors: DataFrame) -> DataFrame:
    """Brands complete in both snapshots and bought from a single vendor."""
    complete = coverage.where(F.col("AllPositions") == F.col("CompletePositions")).select("Brand")
    single = vendors.where(F.col("Vendors") == 1).select("Brand")
    return complete.intersect(single)


def matching(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right.select(*keys), keys, "left_semi")


def key_overlap(
    purchases: DataFrame,
    sales: DataFrame,
    prices: DataFrame,
    invoices: DataFrame,
    begin: DataFrame,
    end: DataFrame,
) -> DataFrame:
    """How many distinct keys each pair of tables shares, one row per pair."""
    bought = purchases.select(F.col("VendorNumber").alias("a"), F.col("Brand").alias("b"))
    orders = purchases.select(F.col("VendorNumber").alias("a"), F.col("PONumber").alias("b"))
    pairs = {
        "purchases and sales": (
            bought, sales.select(F.col("VendorNo").alias("a"), F.col("Brand").alias("b"))
        ),
        "purchases and purchase_prices": (
            bought, prices.select(F.col("VendorNumber").alias("a"), F.col("Brand").alias("b"))
        ),
        "purchase orders and vendor_invoice": (
            orders, invoices.select(F.col("VendorNumber").alias("a"), F.col("PONumber").alias("b"))
        ),
        "begin_inventory and end_inventory": (
            begin.select(F.col("Store").alias("a"), F.col("Brand").alias("b")),
            end.select(F.col("Store").alias("a"), F.col("Brand").alias("b")),
        ),
    }
    out = None
    for name, (left, right) in pairs.items():
        sides = left.withColumn("l", F.lit(1)).unionByName(
            right.withColumn("r", F.lit(1)), allowMissingColumns=True
        )
        keys = sides.groupBy("a", "b").agg(F.max("l").alias("l"), F.max("r").alias("r"))
        row = keys.agg(
            F.lit(name).alias("Pair"),
            F.count("l").alias("LeftKeys"),
            F.count("r").alias("RightKeys"),
            F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("SharedKeys"),
            F.count(F.lit(1)).alias("AllKeys"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _dollars(c: Column | str) -> Column:
    """A total in which nothing at all is 0."""
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def audit(
    purchases: DataFrame,
    sales: DataFrame,
    prices: DataFrame,
    invoices: DataFrame,
    begin: DataFrame,
    end: DataFrame,
) -> DataFrame:
    """Row, key, money and coverage metrics of all six tables plus five checks, as one row.

    Every table is scanned once, by the writes of its groups; all else is read from these.
    """
    held = hold_together(
        {
            "purchase_grains": purchase_grains(purchases),
            "sales_grains": sales_grains(sales),
            "price_keys": key_counts(prices, ["VendorNumber", "Brand"]),
            "invoice_keys": key_counts(invoices, ["VendorNumber", "PONumber"]),
            "positions": position_coverage(begin, end),
        }
    )
    bought_all, sold_all, positions = held["purchase_grains"], held["sales_grains"], held["positions"]
    bought = bought_all.where("Grain = 'pair'").select(
        *PAIR, "PurchaseRows", "PurchaseQuantity", "PurchaseDollars", "CostNumerator", "CostQuantity"
    )
    sold = sold_all.where("Grain = 'pair'").select(*PAIR, "SalesRows", "SalesQuantity", "SalesDollars")
    orders = _with_days(
        bought_all.where("Grain = 'order'").select(
            F.col("Vendor").alias("VendorNumber"), "PONumber", "PODateMin", "PODateMax", "FirstReceivingDate",
            "LastReceivingDate",
        )
    )

    pairs = combined_pairs(bought, sold)
    combined = pairs.agg(
        _dollars("PurchaseDollars").alias("_cpd"),
        F.coalesce(F.sum("PurchaseQuantity"), F.lit(0)).alias("_cpq"),
        _dollars("SalesDollars").alias("_csd"),
        F.coalesce(F.sum("SalesQuantity"), F.lit(0)).alias("_csq"),
        F.count_if(F.col("PurchaseRows").isNotNull() & F.col("SalesRows").isNotNull()).alias(
            "sales_vendor_brand_keys_with_purchases"
        ),
    )
    # one row each; of an empty table none, which the aggregate turns into its totals of nothing
    raw_bought = bought_all.where("Grain = 'all'").agg(
        F.coalesce(F.sum("PurchaseRows"), F.lit(0)).alias("purchase_rows"),
        F.round(_dollars("PurchaseDollars"), 2).alias("purchase_dollars"),
        F.coalesce(F.sum("PurchaseQuantity"), F.lit(0)).alias("purchase_quantity"),
    )
    raw_sold = sold_all.where("Grain = 'all'").agg(
        F.coalesce(F.sum("SalesRows"), F.lit(0)).alias("sales_rows"),
        F.round(_dollars("SalesDollars"), 2).alias("sales_dollars"),
        F.coalesce(F.sum("SalesQuantity"), F.lit(0)).alias("sales_quantity"),
    )
    prices, invoices = held["price_keys"], held["invoice_keys"]
    reference, invoice = repeat_counts(prices), repeat_counts(invoices)
    price_keys = prices.select(F.col("VendorNumber").alias("Vendor"), "Brand")
    vendors = brand_vendor_counts(bought)
    both = (F.col("BeginRows") > 0) & (F.col("EndRows") > 0)

    parts = [
        raw_bought,
        bought.agg(F.count(F.lit(1)).alias("purchase_vendor_brand_keys")),
        raw_sold,
        sold.agg(F.count(F.lit(1)).alias("sales_vendor_brand_keys")),
        matching(sold, bought, PAIR).agg(
            F.round(_dollars("SalesDollars"), 2).alias("sales_revenue_on_keys_with_purchases")
        ),
        reference.select(
            (F.col("DistinctKeys") + F.col("SurplusRows")).alias("reference_vendor_brand_rows"),
            F.col("RepeatedKeys").alias("duplicate_reference_vendor_brand_keys"),
        ),
        matching(bought, price_keys, PAIR).agg(
            F.count(F.lit(1)).alias("purchase_vendor_brand_reference_matches")
        ),
        vendors.agg(
            F.count_if(F.col("Vendors") > 1).alias("brands_with_multiple_purchasing_vendors")
        ),
        invoice.select(
            (F.col("DistinctKeys") + F.col("SurplusRows")).alias("invoice_rows"),
            F.col("SurplusRows").alias("duplicate_vendor_po_invoice_keys"),
        ),
        matching(orders, invoices, ["VendorNumber", "PONumber"]).agg(
            F.count(F.lit(1)).alias("purchase_orders_with_matching_invoice")
        ),
        orders.agg(F.count(F.lit(1)).alias("purchase_order_keys")),
        positions.agg(
            F.coalesce(F.sum("BeginRows"), F.lit(0)).alias("begin_inventory_rows"),
            F.coalesce(F.sum("EndRows"), F.lit(0)).alias("end_inventory_rows"),
            F.count_if(F.col("BeginRows") > 0).alias("begin_store_brand_keys"),
            F.count_if(F.col("EndRows") > 0).alias("end_store_brand_keys"),
            F.count_if(both).alias("store_brand_keys_in_both_snapshots"),
        ),
        eligible_brands(brand_coverage(positions), vendors).agg(
            F.count(F.lit(1)).alias("complete_snapshot_single_vendor_brands")
        ),
        portfolio_lead_times(orders).select(
            F.col("Orders").alias("observed_lead_time_orders"),
            F.col("MedianDays").alias("observed_lead_time_median_days"),
            F.col("StdDays").alias("observed_lead_time_std_days"),
        ),
        duplicate_counts(pairs.select(*PAIR), PAIR).select(
            (F.col("RepeatedKeys") == 0).alias("vendor_brand_summary_unique")
        ),
    ]
    row = combined
    for part in parts:
        row = with_scalars(row, part)
    return row.withColumns(
        {
            "purchase_dollars_reconcile": within("_cpd", "purchase_dollars", 0.01, 1e-10),
            "purchase_quantity_reconcile": F.col("_cpq") == F.col("purchase_quantity"),
            "sales_dollars_reconcile": within("_csd", "sales_dollars", 0.01, 1e-10),
            "sales_quantity_reconcile": F.col("_csq") == F.col("sales_quantity"),
        }
    ).drop("_cpd", "_cpq", "_csd", "_csq")


def procurement_validation(
    orders: DataFrame,
    performance: DataFrame,
    expected_orders: int | None = None,
    expected_median: float | None = None,
    expected_spend: float | None = None,
) -> DataFrame:
    """Portfolio figures against expected values, and the rule that OTIF stays NULL.

    A comparison without an expected value is NULL.
    """
    spend = performance.agg(
        F.sum(money("TotalPurchaseDollars")).cast("double").alias("supplier_purchase_spend"),
        ((F.count("OTIFPct") + F.count("OnTimePct") + F.count("InFullPct")) == 0).alias(
            "otif_columns_all_null"
        ),
    )
    days = portfolio_lead_times(orders).select(
        F.col("Orders").alias("observed_lead_time_orders"),
        F.col("MedianDays").alias("observed_lead_time_median_days"),
        F.col("StdDays").alias("observed_lead_time_std_days"),
    )
    n, median, total = (F.lit(v) for v in (expected_orders, expected_median, expected_spend))
    return with_scalars(spend, days).select(
        "observed_lead_time_orders",
        "observed_lead_time_median_days",
        "observed_lead_time_std_days",
        "supplier_purchase_spend",
        (F.col("observed_lead_time_orders") == n.cast("bigint")).alias(
            "lead_time_order_count_matches_validated"
        ),
        within("observed_lead_time_median_days", median.cast("double"), 1e-9).alias(
            "lead_time_median_matches_validated"
        ),
        within("supplier_purchase_spend", total.cast("double"), 0.01).alias(
            "purchase_spend_matches_validated"
        ),
        F.lit(False).alias("otif_fabricated"),
        "otif_columns_all_null",
    )


def assert_valid(validation: DataFrame) -> dict:
    """Collect the one validation row; raise on a failed comparison or a filled OTIF column."""
    row = validation.first().asDict()
    failed = [k for k, v in row.items() if k.endswith("_matches_validated") and v is False]
    if failed:
        raise DataQualityError(f"procurement validation failed: {failed}; details={row}")
    if not row["otif_columns_all_null"]:
        raise DataQualityError("OTIF columns must remain NULL")
    return row


def reconciliation_snapshot(
    purchases: DataFrame,
    orders: DataFrame,
    performance: DataFrame,
    expected_spend: float | None = None,
    expected_orders: int | None = None,
    expected_median: float | None = None,
    expected_std: float | None = None,
) -> DataFrame:
    """One row of portfolio totals, rates and comparisons."""
    status = F.col("PurchaseOrderMatchStatus") == "Matched"
    po = orders.agg(
        F.count(F.lit(1)).alias("purchase_order_key_count"),
        F.count_if(status).alias("invoice_matched_po_count"),
        F.count_if(F.col("QuantityReconciliationFlag") == "Quantity aligned").alias("_qa"),
        F.count_if(F.col("DollarReconciliationFlag") == "Dollars aligned").alias("_da"),
    )
    suppliers = (
        performance.groupBy("VendorNumber")
        .agg(
            F.sum(money("TotalPurchaseDollars")).alias("d"),
            F.sum(money("TotalPurchaseQuantity")).alias("q"),
        )
        .agg(
            F.sum("d").cast("double").alias("procurement_spend"),
            F.sum("q").cast("double").alias("purchase_quantity"),
            F.count("VendorNumber").alias("supplier_count"),
        )
    )
    lines = purchases.agg(F.count(F.lit(1)).alias("purchase_transaction_records_validated"))
    row = with_scalars(with_scalars(po, suppliers), lines)
    row = with_scalars(row, portfolio_lead_times(orders))

    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")) * 100

    def near(name: str, expected: float | None, tolerance: float) -> Column:
        return within(name, F.lit(expected).cast("double"), tolerance)

    return row.select(
        "procurement_spend",
        near("procurement_spend", expected_spend, 0.01).alias("procurement_spend_matches_validated"),
        "purchase_quantity",
        "purchase_order_key_count",
        "supplier_count",
        F.col("Orders").alias("observed_lead_time_orders"),
        near("Orders", expected_orders, 0.0).alias("observed_lead_time_orders_match"),
        F.col("MedianDays").alias("median_lead_time_days"),
        near("MedianDays", expected_median, 1e-9).alias("median_lead_time_matches"),
        F.col("StdDays").alias("std_lead_time_days"),
        near("StdDays", expected_std, 1e-6).alias("std_lead_time_approx_match"),
        "invoice_matched_po_count",
        share("invoice_matched_po_count", "purchase_order_key_count").alias("invoice_match_pct"),
        share("_qa", "invoice_matched_po_count").alias("quantity_alignment_pct"),
        share("_da", "invoice_matched_po_count").alias("dollar_alignment_pct"),
        F.lit(False).alias("otif_fabricated"),
        "purchase_transaction_records_validated",
    )
