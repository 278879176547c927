"""Every query by name: the Spark plan, and the same result as plain SQL.

A query takes (spark, folder of the raw tables) and returns a DataFrame over whole tables. Its
last step is lazy; tables that several steps read are written when the query is built. Columns that rest on non-decimal sums are given at six decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import aging_bucket_open
from ..functions.ranking import quantiles
from ..functions.workspace import hold, new_folder
from ..operators import (
    audit,
    dashboard,
    dims,
    eda,
    inventory,
    leadtime,
    orders,
    quality,
    risk,
    scorecard,
    stats,
    summary,
    vendors,
)
from ..sources import catalog, files, store as stores
from ..sources.csv_source import csv_path, parsed_date, read_source
from ..sources.readers import StarSchemaSources
from ..sources.schemas import RAW_PURCHASES_COLUMNS, SOURCE_COLUMNS, raw_purchases
from ..sources.store import (
    METHODOLOGY_NOTES,
    SCORECARD_COLUMNS,
    TableStore,
    export_csv,
    ingest,
    planning_extract,
    write_extract,
    write_report,
)
from .model import Model
from .oracle import r6, statement

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, half up, by floor."""
    fixed = {c: F.floor(F.col(f"`{c}`") * 1_000_000.0 + 0.5) / 1_000_000.0 for c in columns}
    return df.select(*[fixed[c].alias(c) if c in fixed else F.col(f"`{c}`") for c in df.columns])


def _add(name: str, make: Callable[[Model], DataFrame], sql: str, fix: Sequence[str] = ()) -> None:
    """Register a query with its SQL; ``fix`` names the columns to give at six decimals."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = make(Model(StarSchemaSources(spark, folder)))
        return rounded(df, *fix) if fix else df

    if fix:
        fixed = ", ".join(f'{r6(chr(34) + c + chr(34))} AS "{c}"' for c in fix)
        sql = f"SELECT * REPLACE ({fixed}) FROM ({sql})"
    QUERIES[name] = run
    ORACLES[name] = statement(sql)


def _table(name: str, cte: str, fix=(), query: str | None = None) -> None:
    _add(query or name, lambda m: m.table(name), f"SELECT * FROM {cte}", fix)


def _t(m: Model, table: str, *columns: str) -> DataFrame:
    return m.src.table(table, *columns)


# ---- orders --------------------------------------------------------------------------

_PO = "fact_purchase_order"
_add(
    "purchase_order_summary",
    lambda m: orders.purchase_order_summary(
        _t(m, "purchases", *orders.PURCHASE_COLUMNS),
        _t(m, "vendor_invoice", *orders.INVOICE_COLUMNS),
    ),
    "SELECT * FROM po",
)
_table(_PO, "pox")
_add(
    "purchase_orders",
    lambda m: orders.purchase_orders(_t(m, "purchases", *orders.PURCHASE_COLUMNS)),
    """SELECT VendorNumber, PONumber, nm AS VendorName, po AS PODate, r1 AS FirstReceivingDate,
        r2 AS LastReceivingDate, inv AS InvoiceDate, pay AS PayDate, q AS PurchaseQuantity,
        d AS PurchaseDollars, n AS PurchaseLineCount,
        CAST(CASE WHEN po = po2 THEN r2 - po END AS INTEGER) AS ObservedLeadTimeDays FROM po_buy""",
)
_add(
    "invoice_orders",
    lambda m: orders.invoice_orders(_t(m, "vendor_invoice", *orders.INVOICE_COLUMNS)),
    """SELECT VendorNumber, PONumber, nm AS InvoiceVendorName, po AS InvoicePODate,
        inv AS InvoiceDate, pay AS InvoicePayDate, q AS InvoiceQuantity, d AS InvoiceDollars,
        f AS Freight FROM po_bill""",
)
_table("fact_delivery_reconciliation", "deliv", query="delivery_reconciliation")
_table("po_cycle_aging_summary", "aging", query="po_cycle_aging")
_add(
    "order_lead_time_view",
    lambda m: orders.order_aging_view(
        orders.order_lead_time_view(
            _t(m, "purchases", "VendorNumber", "PONumber", "PODate", "ReceivingDate", "Quantity", "Dollars")
        )
    ),
    """SELECT VendorNumber AS VENDOR_NUMBER, PONumber AS PO_NUMBER, po AS PO_DATE,
        r2 AS LAST_RECEIVING_DATE, q AS PURCHASE_QUANTITY, d AS PURCHASE_DOLLARS,
        CAST(CASE WHEN po = po2 THEN r2 - po END AS INTEGER) AS OBSERVED_LEAD_TIME_DAYS,
        CASE WHEN OBSERVED_LEAD_TIME_DAYS <= 7 THEN '0-7 days'
            WHEN OBSERVED_LEAD_TIME_DAYS <= 15 THEN '8-15 days'
            WHEN OBSERVED_LEAD_TIME_DAYS <= 30 THEN '16-30 days'
            WHEN OBSERVED_LEAD_TIME_DAYS <= 60 THEN '31-60 days'
            WHEN OBSERVED_LEAD_TIME_DAYS > 60 THEN '60+ days' END AS PO_CYCLE_AGING_BUCKET
    FROM po_buy""",
)
_add(
    "cycle_bucket_variants",
    lambda m: m.table(_PO)
    .groupBy("POCycleAgingBucket", aging_bucket_open("ObservedLeadTimeDays").alias("OpenBucket"))
    .agg(F.count(F.lit(1)).alias("Orders")),
    """SELECT POCycleAgingBucket, CASE WHEN ObservedLeadTimeDays < 0 THEN '0-7 days'
        ELSE POCycleAgingBucket END AS OpenBucket, count(*) AS Orders FROM pox GROUP BY 1, 2""",
)

# ---- inventory -----------------------------------------------------------------------

_table("inventory_position", "pos")
_table("fact_inventory_summary", "posx", query="inventory_summary")
_add(
    "inventory_by_brand",
    lambda m: inventory.inventory_by_brand(m.table("inventory_position")),
    "SELECT * FROM brand_stock",
)

# ---- vendor-brand summary ------------------------------------------------------------

_add(
    "purchase_summary",
    lambda m: summary.purchase_summary(_t(m, "purchases", *summary.PURCHASE_COLUMNS)),
    "SELECT * FROM vb_buy",
)
_add(
    "price_summary",
    lambda m: summary.price_summary(_t(m, "purchase_prices", *summary.PRICE_COLUMNS)),
    "SELECT * FROM vb_price",
)
_add(
    "sales_summary",
    lambda m: summary.sales_summary(_t(m, "sales", *summary.SALES_COLUMNS)),
    "SELECT * FROM vb_sell",
)
_add(
    "freight_by_vendor",
    lambda m: summary.freight_by_vendor(_t(m, "vendor_invoice", "VendorNumber", "Freight")),
    """SELECT VendorNumber, CAST(SUM(CAST(Freight AS DECIMAL(28,4))) AS DOUBLE) AS VendorFreight
    FROM bill GROUP BY 1""",
)


def _purchased(m: Model) -> DataFrame:
    return summary.purchase_summary(_t(m, "purchases", *summary.PURCHASE_COLUMNS))


def _freight(m: Model) -> DataFrame:
    return summary.freight_allocation(
        hold(_purchased(m), "purchase_summary"),
        _t(m, "vendor_invoice", "VendorNumber", "Freight"),
    )


_add(
    "freight_allocation",
    _freight,
    """SELECT VendorNumber, Brand, TotalPurchaseDollars, VendorPurchaseDollars, VendorFreight,
        CASE WHEN VendorPurchaseDollars > 0
            THEN VendorFreight * TotalPurchaseDollars / VendorPurchaseDollars END AS FreightCost
    FROM vb_buy JOIN vend_money USING (VendorNumber)""",
)
_add(
    "vendors_per_brand",
    lambda m: summary.vendors_per_brand(_purchased(m)),
    "SELECT Brand, count(DISTINCT VendorNumber) AS VendorCount FROM buy GROUP BY 1",
)
_add(
    "vendor_brand_keys",
    lambda m: summary.vendor_brand_keys(
        _t(m, "purchases", "VendorNumber", "Brand"), _t(m, "sales", "VendorNo", "Brand")
    ),
    "SELECT VendorNumber, Brand FROM buy UNION SELECT VendorNo, Brand FROM sell",
)
_table("vendor_sales_summary", "vb")
_add(
    "summary_reconciliation",
    Model.summary_checks,
    """SELECT Measure, SummaryTotal, RawTotal, abs(SummaryTotal - RawTotal) <= 0.01::DOUBLE AS Reconciles
    FROM (
        SELECT 'TotalPurchaseDollars' AS Measure,
            CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS SummaryTotal,
            (SELECT CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) FROM buy) AS RawTotal FROM vb
        UNION ALL SELECT 'TotalPurchaseQuantity', SUM(TotalPurchaseQuantity),
            (SELECT CAST(SUM(Quantity) AS DOUBLE) FROM buy) FROM vb
        UNION ALL SELECT 'TotalSalesDollars',
            CAST(SUM(CAST(TotalSalesDollars AS DECIMAL(28,4))) AS DOUBLE),
            (SELECT CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE) FROM sell) FROM vb
        UNION ALL SELECT 'TotalSalesQuantity', SUM(TotalSalesQuantity),
            (SELECT CAST(SUM(SalesQuantity) AS DOUBLE) FROM sell) FROM vb)""",
)

# ---- vendors and brands --------------------------------------------------------------

_VEND_FIX = (
    "WeightedPurchaseCost", "EstimatedGrossProfit", "AllocatedFreight", "WeightedPurchasePrice",
    "EstimatedProfitMarginPct", "FreightPerPurchaseDollar", "EligibleAverageInventoryUnits",
    "EstimatedEndingInventoryCost", "EligibleInventoryTurnover",
    "CumulativePurchaseContributionPct",
)
_CARD_FIX = (
    *_VEND_FIX, "AveragePurchasePriceVariancePct", "AbsoluteAvgPriceVariancePct",
    "SupplierPerformanceScore", "ScoreThresholdP75", "ScoreThresholdP25", "ScoreThresholdP10",
    "LeadTimeConsistencyScore",
)
_RISK_FIX = (
    "AbsoluteAvgPriceVariancePct", "EligibleInventoryTurnover", "EstimatedEndingInventoryCost",
    "SupplierPerformanceScore",
)
_table("vendor_performance_summary", "vend", _VEND_FIX, query="vendor_performance")
_table("Vendor_Purchase_Summary", "vend_cat", query="vendor_purchase_summary")
_table("LowTurnoverVendor", "turn", ("AvgStockTurnOver",), query="low_turnover_vendor")
_table("BrandPerformance", "brand_perf", ("AvgProfitMargin",), query="brand_performance")
_add(
    "vendor_spend_rank",
    lambda m: vendors.spend_ranks(vendors.vendor_totals(m.table("vendor_sales_summary"))),
    "SELECT DISTINCT TotalPurchaseDollars, VendorSpendRank FROM vend",
)
_add(
    "eligible_inventory",
    lambda m: vendors.eligible_inventory(m.table("vendor_sales_summary")),
    "SELECT * FROM vend_stock",
    ("EligibleAverageInventoryUnits", "EstimatedEndingInventoryCost"),
)
_add(
    "top_vendors",
    lambda m: vendors.top_vendors(
        vendors.vendor_totals(m.table("vendor_sales_summary")).where("TotalPurchaseDollars > 0")
    ).select("VendorNumber", "VendorName", "TotalPurchaseDollars"),
    """SELECT VendorNumber, VendorName, TotalPurchaseDollars FROM vend0 WHERE TotalPurchaseDollars > 0
    ORDER BY TotalPurchaseDollars DESC, VendorNumber, VendorName LIMIT 10""",
)

# ---- dimensions ----------------------------------------------------------------------

_table("dim_supplier", "d_supplier")
_table("dim_brand", "d_brand")
_table("dim_store", "d_store")
_table("dim_date", "d_date")
_table("fact_procurement_monthly", "monthly", ("AveragePurchasePrice",), query="procurement_monthly")


def _relationships(m: Model) -> DataFrame:
    names = (
        "dim_supplier", "dim_brand", "dim_store", "dim_date", _PO, "fact_procurement_monthly",
        "fact_inventory_summary", "fact_supplier_performance",
    )
    m.hold_shared(*names)
    return dims.relationship_check({name: m.read(name) for name in names})


def _relationship_sql() -> str:
    known = {
        "dim_supplier": "d_supplier", "dim_brand": "d_brand", "dim_store": "d_store",
        "dim_date": "d_date", "fact_purchase_order": "pox", "fact_supplier_performance": "card",
        "fact_procurement_monthly": "monthly", "fact_inventory_summary": "posx",
    }
    return " UNION ALL ".join(
        f"SELECT '{d}.{dk} -> {f}.{fk}' AS Relationship, count(*) AS FactRows, "
        f"count(*) FILTER (NOT EXISTS (SELECT 1 FROM {known[d]} d WHERE d.{dk} = f.{fk})) AS OrphanRows "
        f"FROM {known[f]} f"
        for d, dk, f, fk in dims.RELATIONSHIPS
    )


_add("star_relationships", _relationships, _relationship_sql())

# ---- lead times ----------------------------------------------------------------------

_add(
    "portfolio_lead_times",
    lambda m: leadtime.portfolio_lead_times(m.table(_PO)),
    "SELECT * FROM lead_all",
)
_table("fact_lead_time", "lead", query="lead_time_detail")
_table("supplier_lead_time_summary", "lead_sup", query="supplier_lead_time")
_table("brand_lead_time_summary", "lead_brand", query="brand_lead_time")
_add(
    "high_cycle_counts",
    lambda m: risk.high_cycle_counts(m.held(_PO)),
    "SELECT VendorNumber, n AS HighCycleTimePOCount FROM slow_po",
)

# ---- scorecard and risk --------------------------------------------------------------

_add(
    "price_variance",
    lambda m: scorecard.price_variance(m.table("vendor_sales_summary")),
    "SELECT * FROM price_var",
    ("AveragePurchasePriceVariancePct", "AbsoluteAvgPriceVariancePct"),
)
_table("fact_supplier_performance", "card", _CARD_FIX, query="supplier_performance")
_table("procurement_planning_risk", "risk", _RISK_FIX, query="planning_risk")


def _anchors(m: Model, off: float) -> dict[str, float]:
    """Expected figures taken from the raw purchases, past the model, and moved by ``off``."""
    raw = _t(m, "purchases", *audit.PURCHASE_COLUMNS)
    days = leadtime.portfolio_lead_times(audit.order_dates(raw))
    spend = raw.agg(F.sum(F.col("Dollars").cast("decimal(28,4)")).cast("double").alias("spend"))
    d, s = days.first(), spend.first()
    return {
        "expected_orders": int(d["Orders"] + off), "expected_median": d["MedianDays"] + off,
        "expected_std": d["StdDays"] + off, "expected_spend": s["spend"] + off,
    }


def _validation(off: float) -> Callable[[Model], DataFrame]:
    def run(m: Model) -> DataFrame:
        anchors = _anchors(m, off)
        anchors.pop("expected_std")
        m.hold_shared("fact_supplier_performance", _PO)
        return audit.procurement_validation(m.read(_PO), m.read("fact_supplier_performance"), **anchors)

    return run


def _snapshot(off: float) -> Callable[[Model], DataFrame]:
    def run(m: Model) -> DataFrame:
        return audit.reconciliation_snapshot(
            _t(m, "purchases", "PONumber"), m.held(_PO),
            vendors.vendor_totals(m.table("vendor_sales_summary")), **_anchors(m, off),
        )

    return run


#: The anchors from the raw lines: one row of orders, median, deviation and spend.
_ANCHOR_SQL = """(SELECT count(*) AS ao, median(days) AS am, stddev_samp(days) AS asd,
        (SELECT SUM(CAST(Dollars AS DECIMAL(28,4))) FROM buy)::DOUBLE AS asp
    FROM (SELECT max(ReceivingDate) - min(PODate) AS days FROM buy GROUP BY VendorNumber, PONumber
          HAVING min(PODate) = max(PODate) AND max(ReceivingDate) IS NOT NULL))"""


def _validation_sql(off: float) -> str:
    return f"""SELECT Orders AS observed_lead_time_orders, MedianDays AS observed_lead_time_median_days,
        StdDays AS observed_lead_time_std_days, spend AS supplier_purchase_spend,
        Orders = ao + {off} AS lead_time_order_count_matches_validated,
        abs(MedianDays - (am + {off})) <= 1e-9::DOUBLE AS lead_time_median_matches_validated,
        abs(spend - (asp + {off})) <= 0.01::DOUBLE AS purchase_spend_matches_validated,
        false AS otif_fabricated, (SELECT count(OTIFPct) + count(OnTimePct) + count(InFullPct) = 0 FROM card) AS otif_columns_all_null
    FROM lead_all, {_ANCHOR_SQL} a,
        (SELECT CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS spend FROM vend0) v"""


_add("procurement_validation", _validation(0), _validation_sql(0))
_add("procurement_validation_off", _validation(1), _validation_sql(1))


def _snapshot_sql(off: float) -> str:
    return f"""SELECT spend AS procurement_spend,
        abs(spend - (asp + {off})) <= 0.01::DOUBLE AS procurement_spend_matches_validated,
        (SELECT SUM(TotalPurchaseQuantity) FROM vend0) AS purchase_quantity,
        k AS purchase_order_key_count,
        (SELECT count(DISTINCT VendorNumber) FROM vend0) AS supplier_count,
        Orders AS observed_lead_time_orders, Orders = ao + {off} AS observed_lead_time_orders_match,
        MedianDays AS median_lead_time_days, abs(MedianDays - (am + {off})) <= 1e-9::DOUBLE AS median_lead_time_matches,
        StdDays AS std_lead_time_days, abs(StdDays - (asd + {off})) <= 1e-6::DOUBLE AS std_lead_time_approx_match,
        mt AS invoice_matched_po_count, mt / k * 100 AS invoice_match_pct,
        qa / mt * 100 AS quantity_alignment_pct, da / mt * 100 AS dollar_alignment_pct,
        false AS otif_fabricated,
        (SELECT count(*) FROM buy) AS purchase_transaction_records_validated
    FROM lead_all, {_ANCHOR_SQL} a,
        (SELECT CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS spend FROM vend0) v,
        (SELECT count(*) AS k, count(*) FILTER (PurchaseOrderMatchStatus = 'Matched') AS mt,
        count(*) FILTER (QuantityReconciliationFlag = 'Quantity aligned') AS qa,
        count(*) FILTER (DollarReconciliationFlag = 'Dollars aligned') AS da FROM pox)"""


_add("reconciliation_snapshot", _snapshot(0), _snapshot_sql(0))
_add("reconciliation_snapshot_off", _snapshot(1), _snapshot_sql(1))

# ---- charts --------------------------------------------------------------------------

_table("chart_monthly_spend", "c_monthly")
_table(
    "chart_top_suppliers", "c_suppliers",
    ("AbsoluteAvgPriceVariancePct", "EstimatedEndingInventoryCost", "SupplierPerformanceScore"),
)
_table("chart_brand_spend", "c_brands")
_table("chart_lead_time_hist", "c_hist")
_table("chart_lead_time_trend", "c_trend")
_table("chart_aging_buckets", "c_aging")
_table("chart_match_status", "c_match")
_table("chart_po_key_metrics", "c_keys")
_table("chart_store_inventory", "c_stores")
_table("chart_brand_inventory", "c_stock")
_table("chart_planning_risk", "c_risk", _RISK_FIX)
_table("chart_supplier_lead_time", "c_lead")
_table("chart_performance_status", "c_status")
_table("chart_inventory_kpis", "c_kpis")

# ---- dashboard pages -----------------------------------------------------------------

_CTE_OF = {
    "chart_monthly_spend": "c_monthly", "chart_top_suppliers": "c_suppliers",
    "chart_brand_spend": "c_brands", "chart_lead_time_hist": "c_hist",
    "chart_lead_time_trend": "c_trend", "chart_aging_buckets": "c_aging",
    "chart_match_status": "c_match", "chart_po_key_metrics": "c_keys",
    "chart_store_inventory": "c_stores", "chart_brand_inventory": "c_stock",
    "chart_planning_risk": "c_risk", "chart_supplier_lead_time": "c_lead",
    "chart_performance_status": "c_status", "fact_supplier_performance": "card",
    "vendor_sales_summary": "vb", "Vendor_Purchase_Summary": "vend_cat",
    "BrandPerformance": "brand_perf", "LowTurnoverVendor": "turn",
}


def _page_tables(m: Model, page: str) -> dict[str, DataFrame]:
    """The tables of a page; one that several visuals read is written once."""
    used = [v.table for v in dashboard.PAGES[page]]
    m.hold_shared(*dict.fromkeys(used))
    return {t: m.held(t) if used.count(t) > 1 else m.read(t) for t in dict.fromkeys(used)}


def _page_sql(page: str) -> str:
    parts = []
    for i, v in enumerate(dashboard.PAGES[page], start=1):
        source = _CTE_OF[v.table]
        head = f"SELECT {i} AS Visual, '{v.kind}' AS Kind, "
        if v.kind == "card":
            where = f" WHERE Metric = '{v.metric}'" if v.metric else ""
            parts.append(
                f"{head} CAST(NULL AS VARCHAR) AS Category, '{v.value}' AS Field, "
                f"CAST(SUM(CAST(\"{v.value}\" AS DECIMAL(28,10))) AS DOUBLE) AS Value FROM {source}{where}"
            )
        elif v.kind == "chart":
            parts.append(
                f"{head} CAST(\"{v.category}\" AS VARCHAR) AS Category, '{v.value}' AS Field, "
                f"CAST(SUM(CAST(\"{v.value}\" AS DECIMAL(28,10))) AS DOUBLE) AS Value "
                f"FROM {source} GROUP BY CAST(\"{v.category}\" AS VARCHAR)"
            )
        elif v.kind == "slicer":
            parts.append(
                f"SELECT DISTINCT {i} AS Visual, '{v.kind}' AS Kind, \"{v.category}\" AS Category, "
                f"'{v.category}' AS Field, CAST(NULL AS DOUBLE) AS Value FROM {source}"
            )
        else:
            parts += [
                f"{head} \"{v.columns[0]}\" AS Category, '{c}' AS Field, "
                f"TRY_CAST(\"{c}\" AS DOUBLE) AS Value FROM {source}"
                for c in v.columns[1:]
            ]
    return " UNION ALL ".join(parts)


for _page in dashboard.PAGES:
    _add(
        f"page_{_page}",
        lambda m, page=_page: dashboard.page_rows(_page_tables(m, page), page),
        _page_sql(_page),
        ("Value",),
    )

# ---- exploration ---------------------------------------------------------------------

_VSS = "vendor_sales_summary"


def _good(m: Model) -> DataFrame:
    return eda.profitable(m.table(_VSS))


_SOURCE_CTE = {
    "purchases": "buy", "sales": "sell", "purchase_prices": "quote", "vendor_invoice": "bill",
    "begin_inventory": "stock0", "end_inventory": "stock1",
}


def _columns_sql(table: str) -> str:
    return ", ".join(SOURCE_COLUMNS[table])


for _name, _source, _key in (
    ("vendor_rows", "purchases", "VendorNumber"), ("vendor_rows_prices", "purchase_prices", "VendorNumber"),
    ("vendor_rows_invoices", "vendor_invoice", "VendorNumber"), ("vendor_rows_sales", "sales", "VendorNo"),
):
    _add(
        _name,
        lambda m, t=_source, k=_key: eda.vendor_rows(_t(m, t), 6, k),
        f"SELECT {_columns_sql(_source)} FROM {_SOURCE_CTE[_source]} WHERE {_key} = 6",
    )
_add("profitable_rows", _good, "SELECT * FROM good")
_add(
    "brand_price_totals",
    lambda m: eda.brand_price_totals(
        _t(m, "purchases", "Brand", "PurchasePrice", "Quantity", "Dollars")
    ),
    """SELECT Brand, PurchasePrice, CAST(SUM(Quantity) AS BIGINT) AS Quantity,
        CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS Dollars FROM buy GROUP BY 1, 2""",
)
_add(
    "brand_sales_totals",
    lambda m: eda.brand_sales_totals(
        _t(m, "sales", "Brand", "SalesDollars", "SalesPrice", "SalesQuantity")
    ),
    """SELECT Brand, CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS SalesDollars,
        CAST(SUM(CAST(SalesPrice AS DECIMAL(28,4))) AS DOUBLE) AS SalesPrice,
        CAST(SUM(SalesQuantity) AS BIGINT) AS SalesQuantity FROM sell GROUP BY 1""",
)
_add(
    "purchases_with_reference",
    lambda m: eda.purchases_with_reference(
        _t(m, "purchases", *summary.PURCHASE_COLUMNS), _t(m, "purchase_prices", *summary.PRICE_COLUMNS)
    ),
    """SELECT p.VendorNumber, p.VendorName, p.Brand, p.Description,
        CAST(SUM(p.Quantity) AS BIGINT) AS TotalPurchaseQuantity,
        CAST(SUM(CAST(p.Dollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalPurchaseDollars,
        CAST(SUM(Quantity * CAST(p.PurchasePrice AS DECIMAL(18,4))) FILTER (p.PurchasePrice > 0 AND Quantity > 0) AS DOUBLE)
            / CAST(SUM(Quantity) FILTER (p.PurchasePrice > 0 AND Quantity > 0) AS DOUBLE) AS WeightedPurchasePrice,
        max(r.Volume) AS Volume, max(r.Price) AS ReferencePrice
    FROM buy p LEFT JOIN quote r USING (Brand, VendorNumber)
    GROUP BY p.VendorNumber, p.VendorName, p.Brand, p.Description""",
    ("WeightedPurchasePrice",),
)
_add(
    "sales_by_vendor_brand",
    lambda m: eda.sales_by_vendor_brand(
        _t(m, "sales", "VendorNo", "Brand", "SalesDollars", "SalesPrice", "SalesQuantity", "ExciseTax")
    ),
    """SELECT VendorNo, Brand, CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalSalesDollars,
        CAST(SUM(CAST(SalesPrice AS DECIMAL(28,4))) AS DOUBLE) AS TotalSalesPrice,
        CAST(SUM(SalesQuantity) AS BIGINT) AS TotalSalesQuantity,
        CAST(SUM(CAST(ExciseTax AS DECIMAL(28,4))) AS DOUBLE) AS TotalExciseTax FROM sell GROUP BY 1, 2""",
)
_add(
    "description_performance",
    lambda m: eda.description_performance(_good(m)),
    "SELECT * FROM by_desc",
    ("ProfitMargin",),
)
_add(
    "target_brands",
    lambda m: eda.target_brands(_good(m)),
    """SELECT Description, TotalSalesDollars, ProfitMargin FROM by_desc, desc_cuts
    WHERE TotalSalesDollars <= ls AND ProfitMargin >= hm""",
    ("ProfitMargin",),
)
_add(
    "target_scatter",
    lambda m: eda.target_scatter(_good(m)),
    """SELECT Description, TotalSalesDollars, ProfitMargin, ls AS LowSalesThreshold,
        hm AS HighMarginThreshold, TotalSalesDollars <= ls AND ProfitMargin >= hm AS TargetBrand
    FROM by_desc, desc_cuts
    WHERE TotalSalesDollars <= 10000 OR (TotalSalesDollars <= ls AND ProfitMargin >= hm)""",
    ("ProfitMargin", "HighMarginThreshold", "LowSalesThreshold"),
)


def _label(value: str) -> str:
    return (
        f"CASE WHEN {value} >= 1000000 THEN printf('%.2fM', {value} / 1000000) "
        f"WHEN {value} >= 1000 THEN printf('%.2fK', {value} / 1000) "
        f"ELSE CAST({value} AS VARCHAR) END"
    )


for _name, _column in (("top_vendor_sales", "VendorName"), ("top_brand_sales", "Description")):
    _add(
        _name,
        lambda m, c=_column: eda.top_by_sales(_good(m), c),
        f"""SELECT {_column}, TotalSalesDollars, {_label('TotalSalesDollars')} AS Label FROM (
            SELECT {_column}, CAST(SUM(CAST(TotalSalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalSalesDollars
            FROM good GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
    )
_EVEN = "round_even({} * 100, 0) / 100"
_add(
    "vendor_name_shares",
    lambda m: eda.vendor_name_shares(_good(m)).drop("_exact"),
    f"""SELECT VendorName, {_EVEN.format('p')} AS TotalPurchaseDollars, {_EVEN.format('g')} AS GrossProfit,
        {_EVEN.format('s')} AS TotalSalesDollars, {_EVEN.format('x')} AS PurchaseContributionPct FROM by_name""",
)
_add(
    "stats_pareto",
    lambda m: eda.pareto(_good(m)),
    f"""SELECT VendorName, {_label(_EVEN.format('p'))} AS TotalPurchaseDollars,
        {_label(_EVEN.format('g'))} AS GrossProfit, {_label(_EVEN.format('s'))} AS TotalSalesDollars,
        pc AS PurchaseContributionPct, CAST(SUM(CAST(pc AS DECIMAL(18,2))) OVER (
            ORDER BY x DESC, VendorName ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS CumulativeContributionPct
    FROM name_top""",
)
_add(
    "stats_top_and_others",
    lambda m: eda.top_and_others(_good(m)),
    """SELECT VendorName AS Vendor, pc AS SharePct FROM name_top UNION ALL
    SELECT 'OTHERS', CAST(100 - SUM(CAST(pc AS DECIMAL(18,2))) AS DOUBLE) FROM name_top""",
)
_add(
    "slow_vendors",
    lambda m: eda.slow_vendors(_good(m)),
    """SELECT VendorName, CAST(SUM(CAST(StockTurnover AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS StockTurnover
    FROM good WHERE StockTurnover < 1 GROUP BY 1 ORDER BY 2, 1 LIMIT 10""",
    ("StockTurnover",),
)
_add(
    "inventory_cost_ranking",
    lambda m: eda.inventory_cost_ranking(m.table("vendor_performance_summary")),
    """SELECT VendorNumber, VendorName, EstimatedEndingInventoryCost, EligibleInventoryBrandCount
    FROM vend0 LEFT JOIN vend_stock USING (VendorNumber, VendorName)""",
    ("EstimatedEndingInventoryCost",),
)
_add(
    "vendor_margins",
    lambda m: eda.vendor_margins(_good(m)),
    "SELECT * FROM vlevel",
    ("GrossProfit", "ProfitMargin"),
)
_add(
    "order_lines",
    lambda m: eda.order_lines(
        _t(m, "purchases", "VendorNumber", "Brand", "PONumber", "Quantity", "PurchasePrice")
    ),
    "SELECT * FROM lines",
)
_SUMMARY_COLUMNS = (
    "VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice", "ActualPrice", "Volume",
    "TotalPurchaseQuantity", "CostCoveredPurchaseQuantity", "TotalPurchaseDollars",
    "TotalSalesDollars", "TotalSalesPrice", "TotalSalesQuantity", "TotalExciseTax", "FreightCost",
    "ReferencePurchasePrice", "PurchasePriceVariance", "AverageInventoryUnits",
    "EndingInventoryUnits", "EndingInventoryRetailValue", "StockTurnover", "Unsold Capital",
    "CostCoveredSalesDollars", "UncostedSalesDollars", "GrossProfit", "ProfitMargin",
    "SalesToPurchaseRatio", "PurchasePriceVariancePct",
)
_TEXT = ("VendorName", "Description")
_KEYS = ("VendorNumber", "Brand")
_NUMERIC = tuple(c for c in _SUMMARY_COLUMNS if c not in _TEXT)


def _type_sql(c: str) -> str:
    return f"replace(lower(any_value(typeof(\"{c}\"))), 'varchar', 'string')"


_add(
    "null_profile",
    lambda m: eda.null_profile(m.table(_VSS).select(*[F.col(f"`{c}`") for c in _SUMMARY_COLUMNS])),
    " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, {_type_sql(c)} AS DataType, count(\"{c}\") AS NonNullCount, "
        f"count(*) - count(\"{c}\") AS NullCount FROM vb"
        for c in _SUMMARY_COLUMNS
    ),
)
_add(
    "untrimmed_counts",
    lambda m: eda.untrimmed_counts(_t(m, "purchases", *_TEXT), _TEXT),
    " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER (length({c}) <> length(trim({c}))) AS Untrimmed FROM buy"
        for c in _TEXT
    ),
)
_add(
    "strip_columns",
    lambda m: eda.strip_columns(_t(m, "purchases", "VendorNumber", *_TEXT), _TEXT).distinct(),
    "SELECT DISTINCT VendorNumber, trim(VendorName) AS VendorName, trim(Description) AS Description FROM buy",
)
_add(
    "fill_numbers",
    lambda m: eda.fill_numbers(m.table(_VSS)),
    "SELECT " + ", ".join(f'"{c}"' if c in _TEXT else f'coalesce("{c}", 0) AS "{c}"' for c in _SUMMARY_COLUMNS) + " FROM vb",
)
for _name, _column in (("category_counts_vendor", "VendorName"), ("category_counts_brand", "Description")):
    _add(
        _name,
        lambda m, c=_column: eda.category_counts(_good(m), c),
        f"SELECT {_column}, count(*) AS Rows FROM good GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    )
#: The columns that put each table's rows in order for a profile or a preview.
_ORDER_OF = {
    "purchases": ("VendorNumber", "PONumber", "Brand"), "sales": ("VendorNo", "Brand", "Store"),
    "purchase_prices": ("VendorNumber", "Brand"), "vendor_invoice": ("VendorNumber", "PONumber"),
    "begin_inventory": ("Store", "Brand"), "end_inventory": ("Store", "Brand"),
}


def _per_table(make: Callable[[Model, str], DataFrame]) -> Callable[[Model], DataFrame]:
    def run(m: Model) -> DataFrame:
        out = None
        for t in _SOURCE_CTE:
            rows = make(m, t).select(F.lit(t).alias("TableName"), "*")
            out = rows if out is None else out.unionByName(rows)
        return out

    return run


_add(
    "type_profile",
    _per_table(lambda m, t: eda.type_profile(_t(m, t), _ORDER_OF[t])),
    " UNION ALL ".join(
        f"""SELECT '{t}' AS TableName, '{c}' AS ColumnName, count(*) AS Sampled,
            count(x) AS Numeric, CASE WHEN count(x) > count(*) * 0.8 THEN 'DOUBLE' ELSE 'STRING' END AS DataType
        FROM (SELECT CASE WHEN position('_' IN v) = 0 THEN TRY_CAST(trim(v) AS DOUBLE) END AS x
              FROM (SELECT CAST({c} AS VARCHAR) AS v, {', '.join(_ORDER_OF[t])} FROM {cte})
              WHERE v <> '' ORDER BY {', '.join(_ORDER_OF[t])}, v LIMIT 30)"""
        for t, cte in _SOURCE_CTE.items()
        for c in SOURCE_COLUMNS[t]
    ),
)
_add(
    "source_preview",
    lambda m: catalog.preview(_t(m, "vendor_invoice").orderBy("PONumber", "VendorNumber")),
    f"SELECT {_columns_sql('vendor_invoice')} FROM bill ORDER BY PONumber, VendorNumber LIMIT 5",
)
for _source in [t for t in _SOURCE_CTE if t != "vendor_invoice"]:
    _by = (*_ORDER_OF[_source], *(c for c in SOURCE_COLUMNS[_source] if c not in _ORDER_OF[_source]))
    _add(
        f"source_preview_{_source}",
        lambda m, t=_source, by=_by: catalog.preview(_t(m, t).orderBy(*by)),
        f"SELECT {_columns_sql(_source)} FROM {_SOURCE_CTE[_source]} "
        f"ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _by)} LIMIT 5",
    )
_add(
    "key_uniqueness",
    lambda m: quality.is_key(_t(m, "vendor_invoice", "PONumber"), "PONumber"),
    """SELECT CAST(count(*) AS BIGINT) AS Rows, count(DISTINCT PONumber) AS DistinctValues,
        count(*) = count(DISTINCT PONumber) AS IsUnique FROM bill""",
)
_add(
    "duplicate_keys",
    lambda m: quality.repeated_keys(
        _t(m, "purchase_prices", "VendorNumber", "Brand"), ["VendorNumber", "Brand"]
    ),
    "SELECT VendorNumber, Brand, count(*) AS Rows FROM quote GROUP BY 1, 2 HAVING count(*) > 1",
)
_add(
    "duplicate_counts",
    lambda m: quality.duplicate_counts(
        _t(m, "purchase_prices", "VendorNumber", "Brand"), ["VendorNumber", "Brand"]
    ),
    """SELECT count(*) AS DistinctKeys, count(*) FILTER (n > 1) AS RepeatedKeys,
        CAST(SUM(n - 1) AS BIGINT) AS SurplusRows
    FROM (SELECT count(*) AS n FROM quote GROUP BY VendorNumber, Brand)""",
)
_add(
    "source_row_counts",
    lambda m: catalog.row_counts((t, _t(m, t, "Brand" if "Brand" in SOURCE_COLUMNS[t] else "PONumber")) for t in _SOURCE_CTE),
    " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, count(*) AS Rows FROM {c}" for t, c in _SOURCE_CTE.items()
    ),
)


def _listed(m: Model) -> DataFrame:
    """The catalog's list of tables, each with its rows."""
    for t in _SOURCE_CTE:
        _t(m, t).createOrReplaceTempView(f"raw_{t}")
    spark = _t(m, "vendor_invoice", "PONumber").sparkSession
    names = catalog.list_tables(spark, "raw_*")
    return catalog.row_counts((t, spark.table(t)) for t in names)


_add(
    "catalog_tables",
    _listed,
    " UNION ALL ".join(
        f"SELECT 'raw_{t}' AS TableName, count(*) AS Rows FROM {c}" for t, c in _SOURCE_CTE.items()
    ),
)
_add(
    "source_columns",
    _per_table(lambda m, t: eda.null_profile(_t(m, t))),
    " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, {_type_sql(c)} AS DataType, count({c}) AS NonNullCount, "
        f"count(*) - count({c}) AS NullCount FROM {cte}"
        for t, cte in _SOURCE_CTE.items()
        for c in SOURCE_COLUMNS[t]
    ),
)
_add(
    "raw_purchases",
    lambda m: raw_purchases(_t(m, "purchases")).select(
        *[F.col(n).cast("bigint" if t.startswith("decimal") else t).alias(n) for n, t, _ in RAW_PURCHASES_COLUMNS]
    ),
    "SELECT " + ", ".join(f"{c} AS {n}" for n, _, c in RAW_PURCHASES_COLUMNS) + " FROM buy",
)


def _profile(table: str, df: DataFrame) -> DataFrame:
    """Per column: values that are not NULL, and the exact total of a numeric one."""
    kinds = SOURCE_COLUMNS[table]
    totals = {c: F.sum(F.col(c).cast("decimal(28,4)")).cast("double") for c, t in kinds.items() if t in ("bigint", "double")}
    counted = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in kinds], *[e.alias(f"t_{c}") for c, e in totals.items()]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("ColumnName"), F.col(f"n_{c}").alias("Known"),
                (F.col(f"t_{c}") if c in totals else F.lit(None).cast("double")).alias("Total"),
            )
            for c in kinds
        ]
    )
    return counted.select(F.explode(cells).alias("c")).select("c.*")


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, count({c}) AS Known, "
    + (f"CAST(SUM(CAST({c} AS DECIMAL(28,4))) AS DOUBLE)" if kind in ("bigint", "double") else "CAST(NULL AS DOUBLE)")
    + f" AS Total FROM {cte}"
    for t, cte in _SOURCE_CTE.items()
    for c, kind in SOURCE_COLUMNS[t].items()
)


def write_csv(df: DataFrame, path: str) -> None:
    """An extract of a round trip, packed: as plain text the six are over twenty times the Parquet they come from."""
    stores.write_csv(df, path, packed=True)


def _ingested(m: Model) -> tuple[TableStore, str]:
    """The six tables written as CSV extracts to the shared folder, and loaded from there."""
    spark = _t(m, "vendor_invoice", "PONumber").sparkSession
    folder = new_folder(spark, "extracts")
    for t in _SOURCE_CTE:
        write_csv(_t(m, t), f"{folder}/{t}.csv")
    store = TableStore(spark, f"{folder}/store")
    ingest(spark, folder, store)
    return store, folder


def _exported(m: Model) -> DataFrame:
    """The published tables exported, written once more as extracts and read back.

    The copies go as soon as the next step has its own, so that two of one table lie beside the store.
    """
    store, folder = _ingested(m)
    spark = store.table("sales").sparkSession
    for t in SOURCE_COLUMNS:  # loaded into the store
        files.remove(spark, csv_path(folder, t))

    def round_trip(_: Model, t: str) -> DataFrame:
        export_csv(store, f"{folder}/export", [t], packed=True)
        again = csv_path(f"{folder}/again", t)  # an export is an extract again once it has the extract's name
        write_csv(spark.read.options(header=True, escape='"').csv(f"{folder}/export/{t}"), again)
        files.remove(spark, f"{folder}/export/{t}")
        found = hold(_profile(t, read_source(spark, f"{folder}/again", t)), "profile")
        files.remove(spark, again)
        return found

    found = _per_table(round_trip)(m)
    files.remove(spark, folder)
    return found


def _report(m: Model) -> DataFrame:
    row = audit.audit(*_audit_tables(m))
    folder = new_folder(row.sparkSession, "report")
    write_report(row, folder)
    return row.sparkSession.read.schema(row.schema).json(folder)


_add("ingest_round_trip", lambda m: _per_table(lambda _, t, s=_ingested(m)[0]: _profile(t, s.table(t)))(m), _PROFILE_SQL)
_add("export_round_trip", _exported, _PROFILE_SQL)


def _with_line_breaks(m: Model) -> DataFrame:
    """Purchases whose descriptions hold line breaks, quotes and commas, written as an extract and loaded."""
    spark = _t(m, "vendor_invoice", "PONumber").sparkSession
    folder = new_folder(spark, "line-breaks")
    broken = F.concat("Description", F.lit('\n"'), "Size", F.lit('",\n\nlast'))
    stores.write_csv(_t(m, "purchases").withColumn("Description", broken), f"{folder}/purchases.csv")
    found = read_source(spark, folder, "purchases", multi_line=True)
    return found.groupBy("Brand", F.replace("Description", F.lit("\n"), F.lit("/")).alias("Description")).agg(
        F.count(F.lit(1)).alias("Rows"), F.sum("Quantity").alias("Quantity")
    )


_add(
    "multi_line_ingest",
    _with_line_breaks,
    """SELECT Brand, replace(Description || chr(10) || '"' || Size || '",' || chr(10) || chr(10) || 'last', chr(10), '/')
        AS Description, count(*) AS Rows, CAST(SUM(Quantity) AS BIGINT) AS Quantity FROM buy GROUP BY ALL""",
)


def _snapshots(m: Model) -> DataFrame:
    """Invoices as two snapshots have them, read after a third has been published and the first expired."""
    invoices = _t(m, "vendor_invoice", "VendorNumber", "Quantity")
    spark = invoices.sparkSession
    store = TableStore(spark, new_folder(spark, "snapshots"))

    def publish(least: int) -> int:
        run = store.new_run()
        return store.publish({"invoices": store.stage(invoices.where(F.col("Quantity") >= least), "invoices", run)[0]})

    publish(0)
    second = store.snapshot(publish(20))
    frame = second.table("invoices")  # planned before the next is published
    third = publish(60)
    store.expire(keep=2)
    both = frame.withColumn("Snapshot", F.lit("earlier")).unionByName(
        store.table("invoices", at=third).withColumn("Snapshot", F.lit("newest"))
    )
    return both.groupBy("Snapshot", "VendorNumber").agg(F.count(F.lit(1)).alias("Invoices"))


_add(
    "snapshot_reads",
    _snapshots,
    """SELECT 'earlier' AS Snapshot, VendorNumber, count(*) AS Invoices FROM bill WHERE Quantity >= 20 GROUP BY 2
    UNION ALL SELECT 'newest', VendorNumber, count(*) FROM bill WHERE Quantity >= 60 GROUP BY 2""",
)
_add(
    "lenient_dates",
    lambda m: _t(m, "purchases", "PONumber", "PODate")
    .select(
        "PONumber",
        F.when(F.col("PONumber") % 7 == 0, F.concat(F.lit("about "), F.col("PODate").cast("string")))
        .otherwise(F.date_format("PODate", "yyyy-M-d")).alias("text"),
    )
    .groupBy(parsed_date(F.col("text")).alias("PODate")).agg(F.count(F.lit(1)).alias("Lines")),
    "SELECT CASE WHEN PONumber % 7 <> 0 THEN PODate END AS PODate, count(*) AS Lines FROM buy GROUP BY 1",
)
_add(
    "sql_query",
    lambda m: catalog.run_query(
        m.src.table("vendor_invoice", "VendorNumber").sparkSession,
        "SELECT VendorNumber, count(*) AS Invoices FROM {invoices} GROUP BY VendorNumber",
        invoices=_t(m, "vendor_invoice", "VendorNumber"),
    ),
    "SELECT VendorNumber, count(*) AS Invoices FROM bill GROUP BY 1",
)


def _extract_parts(m: Model, anchors: dict[str, object]) -> dict[str, DataFrame]:
    names = (
        "fact_supplier_performance", "procurement_planning_risk", "po_cycle_aging_summary",
        "supplier_lead_time_summary", "fact_procurement_monthly",
    )
    m.hold_shared(*names)
    tables = {t: m.read(t) for t in names}
    return planning_extract(tables["fact_supplier_performance"].sparkSession, tables, anchors)


def _extract_rows(m: Model) -> DataFrame:
    """Every row of every part, under the columns of all of them; written as CSV and read back."""
    expected = _anchors(m, 0)
    # What the notes call the expected figures.
    parts = _extract_parts(m, {
        "Validated purchase spend target": f"{expected['expected_spend']:.2f}",
        "Validated observed lead-time orders": expected["expected_orders"],
        "Validated median lead time days": f"{expected['expected_median']:.1f}",
    })
    spark = parts["Methodology Notes"].sparkSession
    folder = new_folder(spark, "extract")
    write_extract(parts, folder, packed=True)
    out = None
    for name, df in parts.items():
        text = spark.read.options(header=True, quote='"', escape='"').csv(f"{folder}/{name.replace(' ', '_')}")
        rows = text.select(F.lit(name).alias("Part"), *[F.col(c).cast(t).alias(c) for c, t in df.dtypes])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


_add(
    "planning_extract_rows",
    _extract_rows,
    f"""SELECT 'Supplier Scorecard' AS Part, {", ".join(SCORECARD_COLUMNS)} FROM card
    UNION ALL BY NAME SELECT 'Procurement Planning Risk' AS Part, * FROM risk
    UNION ALL BY NAME SELECT 'PO Cycle Aging' AS Part, * FROM aging
    UNION ALL BY NAME SELECT 'Supplier Lead Time' AS Part, * FROM lead_sup
    UNION ALL BY NAME SELECT 'Monthly Spend Sample' AS Part, * FROM monthly
    UNION ALL BY NAME SELECT 'Methodology Notes' AS Part, unnest([{", ".join(f"'{n}'" for n in METHODOLOGY_NOTES)},
        'Validated purchase spend target: ' || format('{{:.2f}}',
            (SELECT CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) FROM buy)),
        'Validated observed lead-time orders: ' || (SELECT Orders FROM lead_all),
        'Validated median lead time days: ' || format('{{:.1f}}', (SELECT MedianDays FROM lead_all))]) AS Note""",
    (*[c for c in _CARD_FIX if c in SCORECARD_COLUMNS], *[c for c in _RISK_FIX if c not in SCORECARD_COLUMNS], "AveragePurchasePrice"),
)


def _extract(m: Model) -> DataFrame:
    parts = _extract_parts(m, {})
    out = None
    for name, df in parts.items():
        row = df.agg(
            F.lit(name).alias("Part"),
            F.lit(len(df.columns)).alias("Columns"),
            F.count(F.lit(1)).alias("Rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out


_add(
    "planning_extract_parts",
    _extract,
    """SELECT 'Supplier Scorecard' AS Part, 20 AS Columns, count(*) AS Rows FROM vend0
    UNION ALL SELECT 'Procurement Planning Risk', 29, count(*) FROM vend0
    UNION ALL SELECT 'PO Cycle Aging', 6, count(*) FROM aging
    UNION ALL SELECT 'Supplier Lead Time', 12, count(*) FROM lead_sup
    UNION ALL SELECT 'Monthly Spend Sample', 9, count(*) FROM monthly
    UNION ALL SELECT 'Methodology Notes', 1, 4""",
)

# ---- audit ---------------------------------------------------------------------------


def _audit_tables(m: Model) -> tuple[DataFrame, ...]:
    return (
        _t(m, "purchases", *audit.PURCHASE_COLUMNS),
        _t(m, "sales", *audit.SALES_COLUMNS),
        _t(m, "purchase_prices", "VendorNumber", "Brand"),
        _t(m, "vendor_invoice", "VendorNumber", "PONumber"),
        _t(m, "begin_inventory", "Store", "Brand"),
        _t(m, "end_inventory", "Store", "Brand"),
    )


_OVERLAPS = (
    ("purchases and sales", "SELECT VendorNumber AS a, Brand AS b FROM buy", "SELECT VendorNo, Brand FROM sell"),
    ("purchases and purchase_prices", "SELECT VendorNumber AS a, Brand AS b FROM buy", "SELECT VendorNumber, Brand FROM quote"),
    ("purchase orders and vendor_invoice", "SELECT VendorNumber AS a, PONumber AS b FROM buy", "SELECT VendorNumber, PONumber FROM bill"),
    ("begin_inventory and end_inventory", "SELECT Store AS a, Brand AS b FROM stock0", "SELECT Store, Brand FROM stock1"),
)
_add(
    "key_overlap",
    lambda m: audit.key_overlap(*_audit_tables(m)),
    " UNION ALL ".join(
        f"""SELECT '{name}' AS Pair, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({left}))) AS LeftKeys,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM ({right}))) AS RightKeys,
            (SELECT count(*) FROM (({left}) INTERSECT ({right}))) AS SharedKeys,
            (SELECT count(*) FROM (({left}) UNION ({right}))) AS AllKeys"""
        for name, left, right in _OVERLAPS
    ),
)
_add(
    "complete_brands",
    lambda m: audit.eligible_brands(
        audit.brand_coverage(
            audit.position_coverage(
                _t(m, "begin_inventory", "Store", "Brand"), _t(m, "end_inventory", "Store", "Brand")
            )
        ),
        audit.brand_vendor_counts(
            _t(m, "purchases", "VendorNumber", "Brand")
            .distinct()
            .withColumnRenamed("VendorNumber", "Vendor")
        ),
    ),
    "SELECT Brand FROM brand_ok",
)
_add(
    "vendor_brand_combined",
    lambda m: audit.combined_pairs(
        audit.purchase_pairs(_t(m, "purchases", *audit.PURCHASE_COLUMNS)),
        audit.sales_pairs(_t(m, "sales", *audit.SALES_COLUMNS)),
    ).select(
        "Vendor", "Brand", "PurchaseRows", "PurchaseQuantity", "CostQuantity", "SalesRows",
        "SalesQuantity",
        *[F.col(c).cast("double").alias(c) for c in ("PurchaseDollars", "CostNumerator", "SalesDollars")],
    ),
    """SELECT * FROM (SELECT VendorNumber AS Vendor, Brand, count(*) AS PurchaseRows,
        CAST(SUM(Quantity) AS BIGINT) AS PurchaseQuantity,
        CAST(SUM(Quantity) FILTER (PurchasePrice IS NOT NULL) AS BIGINT) AS CostQuantity,
        CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS PurchaseDollars,
        CAST(SUM(Quantity * CAST(PurchasePrice AS DECIMAL(18,4))) AS DOUBLE) AS CostNumerator
        FROM buy GROUP BY 1, 2)
    FULL JOIN (SELECT VendorNo AS Vendor, Brand, count(*) AS SalesRows,
        CAST(SUM(SalesQuantity) AS BIGINT) AS SalesQuantity,
        CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS SalesDollars FROM sell GROUP BY 1, 2)
    USING (Vendor, Brand)""",
)
_AUDIT_SQL = """SELECT (SELECT count(*) FROM buy) AS purchase_rows,
        (SELECT round(CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE), 2) FROM buy) AS purchase_dollars,
        (SELECT CAST(SUM(Quantity) AS BIGINT) FROM buy) AS purchase_quantity,
        (SELECT count(*) FROM vb_buy) AS purchase_vendor_brand_keys,
        (SELECT count(*) FROM sell) AS sales_rows,
        (SELECT round(CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE), 2) FROM sell) AS sales_dollars,
        (SELECT CAST(SUM(SalesQuantity) AS BIGINT) FROM sell) AS sales_quantity,
        (SELECT count(*) FROM vb_sell) AS sales_vendor_brand_keys,
        (SELECT count(*) FROM vb_sell s WHERE (VendorNo, Brand) IN (SELECT (VendorNumber, Brand) FROM vb_buy))
            AS sales_vendor_brand_keys_with_purchases,
        (SELECT round(coalesce(CAST(SUM(CAST(TotalSalesDollars AS DECIMAL(28,4))) AS DOUBLE), 0), 2) FROM vb_sell s
            WHERE (VendorNo, Brand) IN (SELECT (VendorNumber, Brand) FROM vb_buy)) AS sales_revenue_on_keys_with_purchases,
        (SELECT count(*) FROM quote) AS reference_vendor_brand_rows,
        (SELECT count(*) FROM (SELECT 1 FROM quote GROUP BY VendorNumber, Brand HAVING count(*) > 1))
            AS duplicate_reference_vendor_brand_keys,
        (SELECT count(*) FROM vb_buy WHERE (VendorNumber, Brand) IN (SELECT (VendorNumber, Brand) FROM quote))
            AS purchase_vendor_brand_reference_matches,
        (SELECT count(*) FROM (SELECT 1 FROM vb_buy GROUP BY Brand HAVING count(*) > 1))
            AS brands_with_multiple_purchasing_vendors,
        (SELECT count(*) FROM bill) AS invoice_rows,
        (SELECT count(*) FROM bill) - (SELECT count(*) FROM po_bill) AS duplicate_vendor_po_invoice_keys,
        (SELECT count(*) FROM po WHERE PurchaseOrderMatchStatus = 'Matched') AS purchase_orders_with_matching_invoice,
        (SELECT count(*) FROM po_buy) AS purchase_order_keys,
        (SELECT count(*) FROM stock0) AS begin_inventory_rows, (SELECT count(*) FROM stock1) AS end_inventory_rows,
        (SELECT count(BeginningUnits) FROM pos) AS begin_store_brand_keys,
        (SELECT count(EndingUnits) FROM pos) AS end_store_brand_keys,
        (SELECT count(*) FROM pos WHERE HasBothSnapshots = 1) AS store_brand_keys_in_both_snapshots,
        (SELECT count(*) FROM brand_ok) AS complete_snapshot_single_vendor_brands,
        Orders AS observed_lead_time_orders, MedianDays AS observed_lead_time_median_days,
        StdDays AS observed_lead_time_std_days,
        (SELECT count(*) = count(DISTINCT (VendorNumber, Brand)) FROM vb) AS vendor_brand_summary_unique,
        (SELECT abs(SUM(TotalPurchaseDollars) - (SELECT SUM(Dollars) FROM buy)) <= 0.01::DOUBLE + 1e-9::DOUBLE * abs(SUM(TotalPurchaseDollars)) FROM vb_buy)
            AS purchase_dollars_reconcile,
        (SELECT SUM(q) = (SELECT SUM(Quantity) FROM buy) FROM (SELECT SUM(Quantity) AS q FROM buy GROUP BY VendorNumber, Brand))
            AS purchase_quantity_reconcile,
        (SELECT abs(SUM(TotalSalesDollars) - (SELECT SUM(SalesDollars) FROM sell)) <= 0.01::DOUBLE + 1e-9::DOUBLE * abs(SUM(TotalSalesDollars)) FROM vb_sell)
            AS sales_dollars_reconcile,
        (SELECT SUM(q) = (SELECT SUM(SalesQuantity) FROM sell) FROM (SELECT SUM(SalesQuantity) AS q FROM sell GROUP BY VendorNo, Brand))
            AS sales_quantity_reconcile
    FROM lead_all"""
_add("audit", lambda m: audit.audit(*_audit_tables(m)), _AUDIT_SQL)
_add("report_json", _report, _AUDIT_SQL)

# ---- statistics ----------------------------------------------------------------------

_STAT_COLUMNS = _NUMERIC


def _numbers(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in eda.numeric_columns(df)])


def _long_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, CAST(\"{c}\" AS DOUBLE) AS v FROM {source} WHERE \"{c}\" IS NOT NULL"
        for c in _STAT_COLUMNS
    )


def _sig_sql(c: str) -> str:
    return f"CAST(printf('%.8e', {c}) AS DOUBLE)"


def significant(df: DataFrame, *columns: str) -> DataFrame:
    """Nine significant digits, for figures whose size is not known."""
    fixed = {c: F.format_string("%.8e", F.col(c)).cast("double") for c in columns}
    return df.withColumns({c: F.when(F.col(c).isNotNull(), e) for c, e in fixed.items()})


def _describe_sql(long: str) -> str:
    return f"""SELECT ColumnName, count(*) AS count, {_sig_sql('avg(v)')} AS mean, {_sig_sql('stddev_samp(v)')} AS std,
        {_sig_sql('min(v)')} AS min, {_sig_sql('quantile_cont(v, 0.25)')} AS p25,
        {_sig_sql('quantile_cont(v, 0.5)')} AS p50, {_sig_sql('quantile_cont(v, 0.75)')} AS p75,
        {_sig_sql('max(v)')} AS max FROM ({long}) GROUP BY 1"""


def _histogram_sql(long: str) -> str:
    return f"""SELECT * FROM (WITH long AS MATERIALIZED ({long}),
    s AS (SELECT ColumnName, CASE WHEN min(v) = max(v) THEN min(v) - 0.5::DOUBLE ELSE min(v) END AS lo,
        CASE WHEN min(v) = max(v) THEN max(v) + 0.5::DOUBLE ELSE max(v) END AS hi FROM long GROUP BY 1),
    n AS (SELECT ColumnName, CAST(least(floor((v - lo) / (hi - lo) * 30), 29) AS INTEGER) AS Bin, count(*) AS n
        FROM long JOIN s USING (ColumnName) GROUP BY 1, 2)
    SELECT ColumnName, Bin, lo + (hi - lo) / 30 * Bin AS LowerEdge, lo + (hi - lo) / 30 * (Bin + 1) AS UpperEdge,
        coalesce(n, 0) AS Rows
    FROM (SELECT s.*, CAST(range AS INTEGER) AS Bin FROM s, range(30)) LEFT JOIN n USING (ColumnName, Bin))"""


def _density_sql(long: str) -> str:
    return f"""SELECT ColumnName, Point, {_sig_sql('X')} AS X, {_sig_sql('Density')} AS Density FROM (
        WITH long AS MATERIALIZED ({long}), few AS (SELECT ColumnName, v, count(*) AS ties FROM long GROUP BY 1, 2),
        s AS (SELECT ColumnName, count(*) AS n, min(v) AS lo, max(v) AS hi,
                     stddev_samp(v) * pow(count(*), -0.2::DOUBLE) AS h FROM long GROUP BY 1 HAVING stddev_samp(v) > 0),
        p AS (SELECT s.*, CAST(range AS INTEGER) AS Point, lo + range * ((hi - lo) / 199) AS X FROM s, range(200))
        SELECT ColumnName, Point, X,
            SUM(ties * exp(-0.5::DOUBLE * ((X - v) / h) * ((X - v) / h))) / (max(n) * max(h) * sqrt(2 * pi())) AS Density
        FROM p JOIN few USING (ColumnName) GROUP BY 1, 2, 3)"""


def _box_sql(source: str, group: str) -> str:
    return f"""SELECT b.{group}, Q1, Median, Q3,
        min(v) FILTER (v BETWEEN Q1 - (Q3 - Q1) * 1.5::DOUBLE AND Q3 + (Q3 - Q1) * 1.5::DOUBLE) AS LowerWhisker,
        max(v) FILTER (v BETWEEN Q1 - (Q3 - Q1) * 1.5::DOUBLE AND Q3 + (Q3 - Q1) * 1.5::DOUBLE) AS UpperWhisker,
        count(*) FILTER (v NOT BETWEEN Q1 - (Q3 - Q1) * 1.5::DOUBLE AND Q3 + (Q3 - Q1) * 1.5::DOUBLE) AS Outliers
    FROM ({source}) x JOIN (SELECT {group}, quantile_cont(v, 0.25) AS Q1, quantile_cont(v, 0.5) AS Median,
        quantile_cont(v, 0.75) AS Q3 FROM ({source}) GROUP BY 1) b ON b.{group} = x.{group}
    GROUP BY 1, 2, 3, 4"""


_BOX_FIGURES = ("Q1", "Median", "Q3", "LowerWhisker", "UpperWhisker")


def _sig_all(sql: str, columns: tuple[str, ...]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{_sig_sql(c)} AS {c}' for c in columns)}) FROM ({sql})"


def _corr_sql(source: str) -> str:
    pairs = [
        f"SELECT '{a}' AS ColumnA, '{b}' AS ColumnB, corr(\"{a}\", \"{b}\") AS r FROM {source}"
        for a in _STAT_COLUMNS
        for b in _STAT_COLUMNS
    ]
    return (
        "SELECT ColumnA, ColumnB, CASE WHEN isnan(r) THEN NULL ELSE floor(r * 1000000.0::DOUBLE + 0.5::DOUBLE) "
        f"/ 1000000.0::DOUBLE END AS Correlation FROM ({' UNION ALL '.join(pairs)})"
    )


def _column_statistics(suffix: str, rows: Callable[[Model], DataFrame], source: str) -> None:
    """The plots' figures over every numeric column, chosen by type."""
    long = _long_sql(source)

    def stat(name: str, make: Callable[[DataFrame, list[str]], DataFrame], sql: str) -> None:
        def run(m: Model) -> DataFrame:
            numbers = _numbers(rows(m))
            return make(numbers, numbers.columns)

        _add(f"stats_{name}{suffix}", run, sql)

    figures = ("mean", "std", "min", "p25", "p50", "p75", "max")
    stat("describe", lambda df, cols: significant(stats.describe(df, cols), *figures), _describe_sql(long))
    stat("histogram", stats.histogram, _histogram_sql(long))
    stat("density", lambda df, cols: significant(stats.density(df, cols), "X", "Density"), _density_sql(long))
    stat(
        "boxplot",
        lambda df, cols: significant(stats.boxplot(df, cols), *_BOX_FIGURES),
        _sig_all(_box_sql(long, "ColumnName"), _BOX_FIGURES),
    )
    stat("corr", lambda df, cols: rounded(stats.correlation(df, cols), "Correlation"), _corr_sql(source))


_column_statistics("", lambda m: m.held(_VSS), "vb")
_column_statistics("_profitable", lambda m: hold(_good(m), "profitable"), "good")


def _lines(m: Model) -> DataFrame:
    lines = eda.order_lines(
        _t(m, "purchases", "VendorNumber", "Brand", "PONumber", "Quantity", "PurchasePrice")
    )
    return stats.order_size_classes(lines)


_add(
    "stats_tertiles",
    _lines,
    "SELECT VendorNumber, Brand, PONumber, OrderQuantity, PurchasePrice, OrderSize FROM sized",
)
_add(
    "stats_order_size_price",
    lambda m: significant(stats.order_size_prices(_lines(m)), "PurchasePrice"),
    f"""SELECT OrderSize, count(*) AS OrderLines, {_sig_sql('avg(PurchasePrice)')} AS PurchasePrice
    FROM sized GROUP BY 1""",
)
_add(
    "stats_order_size_boxplot",
    lambda m: significant(stats.order_size_boxplot(_lines(m)), *_BOX_FIGURES),
    _sig_all(_box_sql("SELECT OrderSize, PurchasePrice AS v FROM sized", "OrderSize"), _BOX_FIGURES),
)
_add(
    "stats_quantiles",
    lambda m: significant(
        quantiles(
            m.held(_VSS),
            {"p15": ("TotalSalesDollars", 0.15), "p85": ("ProfitMargin", 0.85), "p10": ("GrossProfit", 0.1)},
        ),
        "p15", "p85", "p10",
    ),
    f"""SELECT {_sig_sql('quantile_cont(TotalSalesDollars, 0.15)')} AS p15,
        {_sig_sql('quantile_cont(ProfitMargin, 0.85)')} AS p85,
        {_sig_sql('quantile_cont(GrossProfit, 0.1)')} AS p10 FROM vb""",
)


def _groups(m: Model) -> DataFrame:
    return stats.sales_groups(hold(eda.vendor_margins(_good(m)), "vendor_margins"))


# The two-sided tail of Student's t with x = sqrt(df) tan(a): an integral of cos(a)^(df - 1).
_TAIL = """(SELECT SUM(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * pow(cos({lo} + (pi() / 2 - {lo}) * i / 4000), {df} - 1)) * (pi() / 2 - {lo}) / 12000
    FROM (SELECT CAST(range AS DOUBLE) AS i FROM range(4001)))"""


def _tail(t: str, df: str) -> str:
    return (
        _TAIL.format(lo=f"atan(abs({t}) / sqrt({df}))", df=df) + " / " + _TAIL.format(lo="0", df=df)
    )


_add(
    "stats_ci",
    lambda m: rounded(stats.confidence_intervals(_groups(m)), "MeanMargin", "Lower", "Upper"),
    f"""SELECT SalesGroup, Vendors, {r6('mean')} AS MeanMargin, {r6('mean - t * se')} AS Lower,
        {r6('mean + t * se')} AS Upper
    FROM (WITH RECURSIVE g AS (SELECT SalesGroup, n, m, sd FROM vmom),
        search(SalesGroup, step, lo, hi) AS (
            SELECT SalesGroup, 0, 0.0::DOUBLE, 200.0::DOUBLE FROM g
            UNION ALL
            SELECT s.SalesGroup, step + 1,
                CASE WHEN tail > 0.05::DOUBLE THEN (lo + hi) / 2 ELSE lo END,
                CASE WHEN tail > 0.05::DOUBLE THEN hi ELSE (lo + hi) / 2 END
            FROM (SELECT s.*, {_tail('((lo + hi) / 2)', '(n - 1)')} AS tail
                  FROM search s JOIN g USING (SalesGroup) WHERE step < 60) s)
        SELECT g.SalesGroup, n AS Vendors, m AS mean, sd / sqrt(n) AS se, (lo + hi) / 2 AS t
        FROM g JOIN search USING (SalesGroup) WHERE step = 60)""",
)
_add(
    "stats_welch",
    lambda m: rounded(stats.welch_test(_groups(m)), "TStatistic", "DegreesOfFreedom", "PValue"),
    f"""SELECT {r6('t')} AS TStatistic, {r6('df')} AS DegreesOfFreedom, {r6('p')} AS PValue,
        p < 0.05::DOUBLE AS RejectEqualMeans
    FROM (SELECT t, df, {_tail('t', 'df')} AS p FROM (
        SELECT (a.m - b.m) / sqrt(a.va / a.n + b.va / b.n) AS t,
            pow(a.va / a.n + b.va / b.n, 2) / (pow(a.va / a.n, 2) / (a.n - 1) + pow(b.va / b.n, 2) / (b.n - 1)) AS df
        FROM vmom a JOIN vmom b ON a.SalesGroup = 'Top' AND b.SalesGroup = 'Low'))""",
)

_GROUP_LONG = "SELECT SalesGroup AS ColumnName, ProfitMargin AS v FROM vgroups"
_add(
    "margin_group_histogram",
    lambda m: stats.histogram(hold(stats.by_group(_groups(m)), "margin_groups"), stats.SALES_GROUPS),
    _histogram_sql(_GROUP_LONG),
)
_add(
    "margin_group_density",
    lambda m: significant(
        stats.density(hold(stats.by_group(_groups(m)), "margin_groups"), stats.SALES_GROUPS), "X", "Density"
    ),
    _density_sql(_GROUP_LONG),
)
