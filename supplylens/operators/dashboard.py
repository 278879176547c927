"""Dashboard pages as queries: cards, charts, tables and slicers over the chart tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fine


@dataclass(frozen=True)
class Visual:
    kind: str
    table: str
    category: str | None = None
    value: str | None = None
    columns: tuple[str, ...] = ()
    metric: str | None = None
    name: str = field(default="")


def _q(name: str):
    return F.col(f"`{name}`")


def card(df: DataFrame, value: str, metric: str | None = None) -> DataFrame:
    """Sum of one column, optionally over the rows of a single metric."""
    rows = df if metric is None else df.where(F.col("Metric") == metric)
    return rows.agg(F.sum(fine(_q(value))).cast("double").alias("Value"))


def chart(df: DataFrame, category: str, value: str) -> DataFrame:
    """Sum per category; ``largest_first`` gives the order in which a chart shows them."""
    return df.groupBy(_q(category).cast("string").alias("Category")).agg(
        F.sum(fine(_q(value))).cast("double").alias("Value")
    )


def largest_first(categories: DataFrame) -> DataFrame:
    return categories.orderBy(F.desc_nulls_last("Value"), "Category")


def table(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.select(*[_q(c) for c in columns])


def slicer(df: DataFrame, column: str) -> DataFrame:
    """The values one can filter by."""
    return df.select(_q(column).cast("string").alias("Choice")).distinct()


_LEAD_COLUMNS = (
    "VendorName", "ObservedLeadTimeOrderCount", "AverageLeadTimeDays", "MedianLeadTimeDays",
    "LeadTimeStdDevDays", "LeadTimeVarianceDays",
)


def _card(t, v, metric=None):
    return Visual("card", t, value=v, metric=metric)


def _chart(t, c, v):
    return Visual("chart", t, category=c, value=v)


# The pages and the columns each visual shows.
PAGES: dict[str, tuple[Visual, ...]] = {
    "executive_overview": (
        _card("chart_top_suppliers", "TotalPurchaseDollars"),
        _card("chart_po_key_metrics", "Value", "PurchaseSidePOKeys"),
        _chart("chart_monthly_spend", "YearMonth", "PurchaseSpend"),
        _chart("chart_top_suppliers", "VendorName", "TotalPurchaseDollars"),
        _chart("chart_performance_status", "PerformanceStatus", "SupplierCount"),
        _chart("chart_aging_buckets", "POCycleAgingBucket", "POCount"),
        _chart("chart_match_status", "PurchaseOrderMatchStatus", "POCount"),
    ),
    "procurement_spend": (
        _card("chart_monthly_spend", "PurchaseSpend"),
        _card("chart_monthly_spend", "PurchaseQuantity"),
        _chart("chart_monthly_spend", "YearMonth", "PurchaseSpend"),
        _chart("chart_top_suppliers", "VendorName", "TotalPurchaseDollars"),
        _chart("chart_brand_spend", "BrandName", "PurchaseSpend"),
        _chart("chart_top_suppliers", "VendorName", "PurchaseContributionPct"),
    ),
    "cycle_time_aging": (
        _chart("chart_aging_buckets", "POCycleAgingBucket", "POCount"),
        _chart("chart_supplier_lead_time", "VendorName", "MedianLeadTimeDays"),
        Visual("table", "chart_supplier_lead_time", columns=_LEAD_COLUMNS),
    ),
    "delivery_reconciliation": (
        _chart("chart_match_status", "PurchaseOrderMatchStatus", "POCount"),
        _chart("chart_top_suppliers", "VendorName", "InvoiceMatchRatePct"),
        Visual(
            "table",
            "chart_top_suppliers",
            columns=(
                "VendorName", "MatchedPOCount", "PurchaseOrderKeyCount", "InvoiceMatchRatePct",
                "QuantityAlignmentRatePct", "DollarAlignmentRatePct", "TotalPurchaseDollars",
            ),
        ),
    ),
    "lead_time_analytics": (
        _chart("chart_lead_time_hist", "LeadTimeDays", "POCount"),
        _chart("chart_lead_time_trend", "YearMonth", "AvgLeadTimeDays"),
        _chart("chart_supplier_lead_time", "VendorName", "LeadTimeStdDevDays"),
        Visual("table", "chart_supplier_lead_time", columns=_LEAD_COLUMNS),
    ),
    "inventory_availability": (
        _chart("chart_store_inventory", "Store", "EndingUnits"),
        _chart("chart_store_inventory", "Store", "BeginningUnits"),
        _chart("chart_brand_inventory", "Brand", "EndingRetailValue"),
        _chart("chart_brand_inventory", "Brand", "LowInventoryFlag"),
    ),
    "supplier_detail": (
        Visual("slicer", "fact_supplier_performance", category="VendorName"),
        Visual("slicer", "fact_supplier_performance", category="PerformanceStatus"),
        _chart("fact_supplier_performance", "VendorName", "TotalPurchaseDollars"),
        Visual(
            "table",
            "fact_supplier_performance",
            columns=(
                "VendorName", "PurchaseOrderKeyCount", "TotalPurchaseDollars",
                "TotalPurchaseQuantity", "AverageLeadTimeDays", "MedianLeadTimeDays",
                "LeadTimeStdDevDays", "LeadTimeVarianceDays", "InvoiceMatchRatePct",
                "QuantityAlignmentRatePct", "DollarAlignmentRatePct",
                "AbsoluteAvgPriceVariancePct", "EstimatedEndingInventoryCost",
                "PerformanceStatus",
            ),
        ),
    ),
    "planning_risk": (
        _chart("chart_planning_risk", "VendorName", "RiskFlagCount"),
        _chart("chart_planning_risk", "VendorName", "TotalPurchaseDollars"),
        _chart("chart_planning_risk", "VendorName", "MedianLeadTimeDays"),
        Visual(
            "table",
            "chart_planning_risk",
            columns=(
                "VendorName", "TotalPurchaseDollars", "PurchaseContributionPct",
                "MedianLeadTimeDays", "LeadTimeStdDevDays", "InvoiceMatchRatePct",
                "AbsoluteAvgPriceVariancePct", "HighCycleTimePOCount", "RiskFlagCount",
                "PerformanceStatus", "RecommendedAttention",
            ),
        ),
    ),
    "vendor_performance": (
        _card("vendor_sales_summary", "TotalSalesDollars"),
        _card("vendor_sales_summary", "TotalPurchaseDollars"),
        _card("vendor_sales_summary", "GrossProfit"),
        _chart("Vendor_Purchase_Summary", "Vendor Category", "TotalPurchaseDollars"),
        _chart("BrandPerformance", "Description", "TotalSales"),
        Visual("table", "LowTurnoverVendor", columns=("VendorName", "AvgStockTurnOver")),
    ),
}


def visual(df: DataFrame, v: Visual) -> DataFrame:
    if v.kind == "card":
        return card(df, v.value, v.metric)
    if v.kind == "chart":
        return chart(df, v.category, v.value)
    if v.kind == "slicer":
        return slicer(df, v.category)
    return table(df, v.columns)


def page(tables: Mapping[str, DataFrame], name: str) -> list[tuple[Visual, DataFrame]]:
    """Every visual of a page with its query, charts in the order they are shown in."""
    shown = [(v, visual(tables[v.table], v)) for v in PAGES[name]]
    return [(v, largest_first(df) if v.kind == "chart" else df) for v, df in shown]


def page_rows(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A page as one long table: (Visual, Kind, Category, Field, Value as text or number).

    Cards and charts give one number per category; slicers give their choices; a table
    gives one cell per row and numeric column, labelled by its first column.
    """
    parts = []
    for position, v in enumerate(PAGES[name], start=1):
        df = visual(tables[v.table], v)
        if v.kind == "card":
            rows = df.select(F.lit(None).cast("string"), F.lit(v.value), "Value")
        elif v.kind == "chart":
            rows = df.select("Category", F.lit(v.value), "Value")
        elif v.kind == "slicer":
            rows = df.select("Choice", F.lit(v.category), F.lit(None).cast("double"))
        else:
            label = v.columns[0]
            cells = F.array(
                *[
                    F.struct(F.lit(c).alias("f"), F.col(c).try_cast("double").alias("x"))
                    for c in v.columns[1:]
                ]
            )
            rows = df.select(F.col(label), F.explode(cells).alias("c")).select(
                label, "c.f", "c.x"
            )
        parts.append(
            rows.toDF("Category", "Field", "Value").select(
                F.lit(position).alias("Visual"), F.lit(v.kind).alias("Kind"),
                "Category", "Field", "Value",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
