"""The table model: every analytical table as a function of the six source tables.

A table that feeds several others is written once (see ``hold``) and read back, the way
the published tables feed the next step; a table asked for on its own stays lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession

from ..functions.workspace import hold, release_since, written
from ..operators import (
    charts,
    dims,
    inventory,
    leadtime,
    orders,
    quality,
    risk,
    scorecard,
    summary,
    vendors,
)
from ..operators.audit import assert_valid, procurement_validation
from ..sources.store import TableStore


class Model:
    def __init__(self, src):
        self.src = src
        self._held: dict[str, DataFrame] = {}

    def held(self, name: str) -> DataFrame:
        """A table for use by several consumers, computed once."""
        if name not in self._held:
            self._held[name] = hold(self.table(name), name)
        return self._held[name]

    def hold_all(self, *names: str) -> None:
        """Compute several tables for later use, one after the other: on disk are the shuffles of one of them."""
        for name in names:
            self.held(name)

    def hold_shared(self, *names: str) -> None:
        """Compute once every table that two or more of these, or of what they read, depend on.

        A table needed by one consumer stays a part of that consumer's plan.
        """
        users: dict[str, set[str]] = {}
        order: list[str] = []

        def visit(name: str) -> None:
            if name in order:
                return
            for parent in READS.get(name, ()):
                users.setdefault(parent, set()).add(name)
                visit(parent)
            order.append(name)

        for name in names:
            users.setdefault(name, set()).add("")
            visit(name)
        for name in order:  # parents come first
            if len(users[name]) > 1:
                self.held(name)

    def adopt(self, name: str, df: DataFrame) -> None:
        """Use an already written copy of a table."""
        self._held[name] = df

    def read(self, name: str) -> DataFrame:
        """A table that has been written if there is one, else its lazy plan."""
        return self._held[name] if name in self._held else self.table(name)

    def table(self, name: str) -> DataFrame:
        return TABLES[name](self)

    # -- pieces of the model ---------------------------------------------------------

    def fact_purchase_order(self) -> DataFrame:
        return orders.enhance_purchase_orders(
            orders.purchase_order_summary(
                self.src.table("purchases", *orders.PURCHASE_COLUMNS),
                self.src.table("vendor_invoice", *orders.INVOICE_COLUMNS),
            )
        )

    def inventory_position(self) -> DataFrame:
        return inventory.inventory_position(
            self.src.table("begin_inventory", *inventory.SNAPSHOT_COLUMNS),
            self.src.table("end_inventory", *inventory.SNAPSHOT_COLUMNS),
        )

    def vendor_sales_summary(self) -> DataFrame:
        return summary.vendor_sales_summary(
            self.src.table("purchases", *summary.PURCHASE_COLUMNS),
            self.src.table("sales", *summary.SALES_COLUMNS),
            self.src.table("purchase_prices", *summary.PRICE_COLUMNS),
            self.src.table("vendor_invoice", "VendorNumber", "Freight"),
            inventory.inventory_by_brand(self.read("inventory_position")),
        )

    def brand_lead_times(self) -> DataFrame:
        return leadtime.brand_lead_times(
            self.src.table("purchases", "VendorNumber", "PONumber", "Brand", "Description"),
            self.read("fact_purchase_order"),
        )

    def dim_store(self) -> DataFrame:
        return dims.dim_store(
            self.src.table("begin_inventory", "Store", "City"),
            self.src.table("end_inventory", "Store", "City"),
            self.src.table("purchases", "Store"),
        )

    def dim_date(self) -> DataFrame:
        return dims.dim_date(
            dims.date_bounds(
                self.src.table("purchases", "PODate", "ReceivingDate"),
                self.src.table("sales", "SalesDate"),
                self.src.table("vendor_invoice", "InvoiceDate"),
            )
        )

    def supplier_performance(self) -> DataFrame:
        self.hold_all("fact_purchase_order", "vendor_sales_summary")
        return scorecard.supplier_performance(
            self.read("vendor_performance_summary"),
            self.read("supplier_lead_time_summary"),
            self.read("fact_delivery_reconciliation"),
            self.read("vendor_sales_summary"),
        )

    def summary_checks(self) -> DataFrame:
        return quality.summary_reconciliation(
            self.held("vendor_sales_summary"),
            self.src.table("purchases", "Dollars", "Quantity"),
            self.src.table("sales", "SalesDollars", "SalesQuantity"),
        )


# Every table of the model.
TABLES: dict[str, Callable[[Model], DataFrame]] = {
    "inventory_position": Model.inventory_position,
    "fact_purchase_order": Model.fact_purchase_order,
    "vendor_sales_summary": Model.vendor_sales_summary,
    "purchase_order_summary": lambda m: m.read("fact_purchase_order"),
    "vendor_performance_summary": lambda m: vendors.vendor_performance(
        m.held("vendor_sales_summary")
    ),
    "Vendor_Purchase_Summary": lambda m: vendors.vendor_purchase_summary(
        m.read("vendor_sales_summary")
    ),
    "LowTurnoverVendor": lambda m: vendors.low_turnover_vendors(m.read("vendor_sales_summary")),
    "BrandPerformance": lambda m: vendors.brand_performance(m.read("vendor_sales_summary")),
    "dim_supplier": lambda m: dims.dim_supplier(
        m.src.table(
            "purchases", "VendorNumber", "VendorName", "Brand", "PONumber", "Quantity", "Dollars"
        )
    ),
    "dim_brand": lambda m: dims.dim_brand(
        m.src.table("purchases", "Brand", "VendorNumber", "Description", "Size", "Classification")
    ),
    "dim_store": Model.dim_store,
    "dim_date": Model.dim_date,
    "fact_lead_time": lambda m: leadtime.lead_time_detail(m.held("fact_purchase_order")),
    "supplier_lead_time_summary": lambda m: leadtime.supplier_lead_times(
        m.read("fact_lead_time")
    ),
    "brand_lead_time_summary": Model.brand_lead_times,
    "fact_delivery_reconciliation": lambda m: orders.delivery_reconciliation(
        m.read("fact_purchase_order")
    ),
    "fact_supplier_performance": Model.supplier_performance,
    "procurement_planning_risk": lambda m: risk.planning_risk(
        m.held("fact_supplier_performance"), m.held("fact_purchase_order")
    ),
    "po_cycle_aging_summary": lambda m: orders.po_cycle_aging(m.read("fact_purchase_order")),
    "fact_procurement_monthly": lambda m: dims.procurement_monthly(
        m.src.table("purchases", *dims.MONTHLY_COLUMNS)
    ),
    "fact_inventory_summary": lambda m: inventory.inventory_summary(m.read("inventory_position")),
    "chart_monthly_spend": lambda m: charts.monthly_spend(m.read("fact_procurement_monthly")),
    "chart_top_suppliers": lambda m: charts.top_suppliers(m.read("fact_supplier_performance")),
    "chart_brand_spend": lambda m: charts.brand_spend(m.read("fact_procurement_monthly")),
    "chart_lead_time_hist": lambda m: charts.lead_time_histogram(m.read("fact_lead_time")),
    "chart_lead_time_trend": lambda m: charts.lead_time_trend(m.read("fact_lead_time")),
    "chart_aging_buckets": lambda m: charts.aging_buckets(m.read("po_cycle_aging_summary")),
    "chart_match_status": lambda m: charts.match_status(m.read("fact_purchase_order")),
    "chart_po_key_metrics": lambda m: charts.po_key_metrics(m.read("fact_purchase_order")),
    "chart_store_inventory": lambda m: charts.store_inventory(m.read("fact_inventory_summary")),
    "chart_brand_inventory": lambda m: charts.brand_inventory(m.read("fact_inventory_summary")),
    "chart_planning_risk": lambda m: charts.planning_risk_top(
        m.read("procurement_planning_risk")
    ),
    "chart_supplier_lead_time": lambda m: charts.supplier_lead_time_top(
        m.read("supplier_lead_time_summary")
    ),
    "chart_performance_status": lambda m: charts.performance_status_counts(
        m.read("fact_supplier_performance")
    ),
    "chart_inventory_kpis": lambda m: charts.inventory_kpis(m.read("fact_inventory_summary")),
}

_SCORE, _RISK = "fact_supplier_performance", "procurement_planning_risk"
_PO, _VSS, _INV = "fact_purchase_order", "vendor_sales_summary", "inventory_position"

# What each table reads besides the source tables.
READS: dict[str, tuple[str, ...]] = {
    _VSS: (_INV,),
    "purchase_order_summary": (_PO,),
    "vendor_performance_summary": (_VSS,),
    "Vendor_Purchase_Summary": (_VSS,),
    "LowTurnoverVendor": (_VSS,),
    "BrandPerformance": (_VSS,),
    "fact_lead_time": (_PO,),
    "supplier_lead_time_summary": ("fact_lead_time",),
    "brand_lead_time_summary": (_PO,),
    "fact_delivery_reconciliation": (_PO,),
    _SCORE: (
        _PO, _VSS, "vendor_performance_summary", "supplier_lead_time_summary",
        "fact_delivery_reconciliation",
    ),
    _RISK: (_SCORE, _PO),
    "po_cycle_aging_summary": (_PO,),
    "fact_inventory_summary": (_INV,),
    "chart_monthly_spend": ("fact_procurement_monthly",),
    "chart_top_suppliers": (_SCORE,),
    "chart_brand_spend": ("fact_procurement_monthly",),
    "chart_lead_time_hist": ("fact_lead_time",),
    "chart_lead_time_trend": ("fact_lead_time",),
    "chart_aging_buckets": ("po_cycle_aging_summary",),
    "chart_match_status": (_PO,),
    "chart_po_key_metrics": (_PO,),
    "chart_store_inventory": ("fact_inventory_summary",),
    "chart_brand_inventory": ("fact_inventory_summary",),
    "chart_planning_risk": (_RISK,),
    "chart_supplier_lead_time": ("supplier_lead_time_summary",),
    "chart_performance_status": (_SCORE,),
    "chart_inventory_kpis": ("fact_inventory_summary",),
}

# The grain each table must keep.
GRAINS: dict[str, list[str]] = {
    "vendor_sales_summary": ["VendorNumber", "Brand"],
    "vendor_performance_summary": ["VendorNumber", "VendorName"],
    "fact_supplier_performance": ["VendorNumber", "VendorName"],
    "procurement_planning_risk": ["VendorNumber", "VendorName"],
    "fact_procurement_monthly": ["VendorNumber", "Brand", "SpendMonth"],
}


def build(
    spark: SparkSession,
    src,
    store: TableStore,
    expected_orders: int | None = None,
    expected_median: float | None = None,
    expected_spend: float | None = None,
    threads: int = 8,
) -> dict[str, int]:
    """Build, check and publish every table at once; returns the row counts.

    Each staged table serves the later ones, so nothing is computed twice; a table is begun as
    soon as those it reads are there, side by side with others. The grain and reconciliation checks
    run before anything becomes visible. Intermediates are deleted at the end, and what a failed
    run has staged too; no other query of this process may be running meanwhile.
    """
    mark = written()
    model, run = Model(src), store.new_run()
    staged: dict[str, str] = {}
    counts: dict[str, int] = {}

    def make(name: str) -> None:
        if name == "purchase_order_summary":
            staged[name], counts[name] = staged[_PO], counts[_PO]
            return
        df = model.table(name)
        staged[name], counts[name] = store.stage(df, name, run)
        written = spark.read.schema(df.schema).parquet(staged[name])
        if name in GRAINS:
            quality.assert_unique(written, GRAINS[name], name)
        model.adopt(name, written)

    waiting, running, done = list(TABLES), {}, set()
    try:
        with ThreadPoolExecutor(threads) as pool:
            while waiting or running:
                for name in [n for n in waiting if done.issuperset(READS.get(n, ()))]:
                    waiting.remove(name)
                    running[pool.submit(make, name)] = name
                for job in wait(running, return_when=FIRST_COMPLETED).done:
                    done.add(running.pop(job))
                    job.result()

        quality.assert_reconciles(model.summary_checks())
        assert_valid(
            procurement_validation(
                model.read(_PO), model.read(_SCORE), expected_orders, expected_median, expected_spend
            )
        )
    except Exception:
        store.discard(run)
        raise
    store.publish(staged)
    release_since(spark, mark)
    return counts
