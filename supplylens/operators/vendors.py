"""Vendor- and brand-level tables built on the vendor-brand summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MONEY, money, ratio, sum_or_null, sum_or_zero
from ..functions.frames import with_scalars
from ..functions.ranking import quantiles, ranked_rows, value_ranks
from ..functions.workspace import hold

NAME_KEYS = ["VendorNumber", "VendorName"]
OTHERS = "Others"


def _totals() -> list[Column]:
    return [
        sum_or_zero("TotalPurchaseQuantity", MONEY).alias("TotalPurchaseQuantity"),
        sum_or_zero("CostCoveredPurchaseQuantity", MONEY).alias("CostCoveredPurchaseQuantity"),
        sum_or_zero("TotalPurchaseDollars", MONEY).alias("TotalPurchaseDollars"),
        sum_or_zero("TotalSalesQuantity", MONEY).alias("TotalSalesQuantity"),
        sum_or_zero("TotalSalesDollars", MONEY).alias("TotalSalesDollars"),
        sum_or_null("CostCoveredSalesDollars", MONEY).alias("CostCoveredSalesDollars"),
        sum_or_zero("UncostedSalesDollars", MONEY).alias("UncostedSalesDollars"),
        sum_or_zero(F.col("PurchasePrice") * F.col("CostCoveredPurchaseQuantity")).alias(
            "WeightedPurchaseCost"
        ),
        sum_or_null("GrossProfit").alias("EstimatedGrossProfit"),
        sum_or_null("FreightCost").alias("AllocatedFreight"),
    ]


def _ratios(totals: DataFrame) -> DataFrame:
    return totals.select(
        "*",
        ratio("WeightedPurchaseCost", "CostCoveredPurchaseQuantity").alias("WeightedPurchasePrice"),
        ratio("EstimatedGrossProfit", "CostCoveredSalesDollars", 100.0).alias(
            "EstimatedProfitMarginPct"
        ),
        ratio("TotalSalesDollars", "TotalPurchaseDollars").alias("SalesToPurchaseRatio"),
        ratio("AllocatedFreight", "TotalPurchaseDollars").alias("FreightPerPurchaseDollar"),
    )


def vendor_totals(summary: DataFrame) -> DataFrame:
    """Sums and ratios per vendor name, before any comparison between vendors."""
    return _ratios(summary.groupBy(*NAME_KEYS).agg(*_totals()))


def spend_ranks(totals: DataFrame) -> DataFrame:
    """Competition rank of every spend that occurs, the largest first."""
    return value_ranks(totals, ["TotalPurchaseDollars"]).select(
        F.col("value").alias("TotalPurchaseDollars"),
        (F.col("total") - F.col("below") - F.col("ties") + 1).alias("VendorSpendRank"),
    )


_ELIGIBLE = "StockTurnover IS NOT NULL"


def _stock() -> list[Column]:
    """What a vendor's eligible rows add up to; of other rows nothing counts."""
    def only(c: str) -> Column:
        return F.when(F.expr(_ELIGIBLE), F.col(c))

    return [
        # a vendor has each brand in one row
        F.count(only("Brand")).alias("EligibleInventoryBrandCount"),
        sum_or_zero(only("TotalSalesQuantity"), MONEY).alias("EligibleSalesUnits"),
        sum_or_null(only("AverageInventoryUnits")).alias("EligibleAverageInventoryUnits"),
        sum_or_null(only("EndingInventoryUnits")).alias("EligibleEndingInventoryUnits"),
        sum_or_null(only("`Unsold Capital`")).alias("EstimatedEndingInventoryCost"),
    ]


def eligible_inventory(summary: DataFrame) -> DataFrame:
    """Inventory of brands whose stock can be attributed to one vendor."""
    return summary.where(_ELIGIBLE).groupBy(*NAME_KEYS).agg(*_stock())


def vendor_figures(summary: DataFrame) -> DataFrame:
    """``vendor_totals`` and ``eligible_inventory`` of every vendor, by one grouping of the summary."""
    eligible = F.count_if(F.expr(_ELIGIBLE))
    grouped = _ratios(summary.groupBy(*NAME_KEYS).agg(*_totals(), *_stock(), eligible.alias("_rows")))
    # a vendor without eligible rows has no figures of them, not zeros
    names = ("EligibleInventoryBrandCount", "EligibleSalesUnits")
    return grouped.withColumns({n: F.when(F.col("_rows") > 0, F.col(n)) for n in names}).drop("_rows")


# Output order of the vendor performance table.
PERFORMANCE_COLUMNS = (
    "VendorNumber", "VendorName", "TotalPurchaseQuantity", "CostCoveredPurchaseQuantity",
    "TotalPurchaseDollars", "TotalSalesQuantity", "TotalSalesDollars", "CostCoveredSalesDollars",
    "UncostedSalesDollars", "WeightedPurchaseCost", "EstimatedGrossProfit", "AllocatedFreight",
    "WeightedPurchasePrice", "EstimatedProfitMarginPct", "SalesToPurchaseRatio",
    "FreightPerPurchaseDollar", "PurchaseContributionPct", "SalesContributionPct",
    "VendorSpendRank", "CumulativePurchaseContributionPct", "EligibleInventoryBrandCount",
    "EligibleSalesUnits", "EligibleAverageInventoryUnits", "EligibleEndingInventoryUnits",
    "EstimatedEndingInventoryCost", "EligibleInventoryTurnover",
)


def vendor_performance(summary: DataFrame) -> DataFrame:
    """One row per vendor number and name; two spellings of a vendor are two rows.

    Rank, running share and the totals behind the shares come from one ordering of the vendors by
    spend, the largest first. The share counts positive spend only.
    """
    spent = F.col("TotalPurchaseDollars") > 0
    sums = {
        "_spend": F.when(spent, money("TotalPurchaseDollars")).otherwise(F.lit(0).cast(MONEY)),
        "_sales": money("TotalSalesDollars"),
    }
    ranked = ranked_rows(vendor_figures(summary), -F.col("TotalPurchaseDollars"), NAME_KEYS, sums)
    return ranked.withColumns(
        {
            "VendorSpendRank": F.col("below") + 1,
            "PurchaseContributionPct": F.when(spent, ratio("TotalPurchaseDollars", "_spend_total", 100.0)),
            "SalesContributionPct": ratio("TotalSalesDollars", "_sales_total", 100.0),
            "CumulativePurchaseContributionPct": F.coalesce(ratio("_spend", "_spend_total", 100.0), F.lit(0.0)),
            "EligibleInventoryTurnover": ratio("EligibleSalesUnits", "EligibleAverageInventoryUnits"),
        }
    ).select(*PERFORMANCE_COLUMNS)


def top_vendors(vendors: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest vendor rows by spend."""
    return vendors.orderBy(F.desc("TotalPurchaseDollars"), *NAME_KEYS).limit(n)


def vendor_purchase_summary(summary: DataFrame) -> DataFrame:
    """Spend of the top ten vendors and of all others.

    Membership goes by vendor number, so another spelling of a top vendor keeps its own
    name. The top set's share is shown on the largest category only.
    """
    vendors = hold(
        summary.groupBy(*NAME_KEYS)
        .agg(F.sum(money("TotalPurchaseDollars")).alias("TotalPurchaseDollars"))
        .where("TotalPurchaseDollars > 0"),
        "vendor_spend",
    )
    leaders = top_vendors(vendors).select("VendorNumber").distinct().withColumn("_top", F.lit(True))
    labelled = vendors.join(F.broadcast(leaders), "VendorNumber", "left").withColumn(
        "Vendor Category", F.when(F.col("_top"), F.col("VendorName")).otherwise(OTHERS)
    )
    categories = (
        labelled.where(F.col("`Vendor Category`").isNotNull())
        .groupBy("Vendor Category")
        .agg(F.sum("TotalPurchaseDollars").alias("amount"))
    )
    portfolio = labelled.agg(
        ratio(
            F.coalesce(F.sum(F.when(F.col("_top"), F.col("TotalPurchaseDollars"))), F.lit(0)),
            F.sum("TotalPurchaseDollars"),
            100.0,
        ).alias("_share")
    )
    largest = (
        categories.orderBy(F.desc("amount"), "Vendor Category")
        .limit(1)
        .agg(F.max("Vendor Category").alias("_largest"))
    )
    flagged = with_scalars(with_scalars(categories, portfolio), largest)
    return flagged.select(
        "Vendor Category",
        F.col("amount").cast("double").alias("TotalPurchaseDollars"),
        F.when(F.col("Vendor Category") == F.col("_largest"), F.col("_share"))
        .otherwise(0.0)
        .alias("Top10Cont"),
    )


def low_turnover_vendors(summary: DataFrame) -> DataFrame:
    """Stock turnover of every vendor that has attributable inventory."""
    return (
        summary.where(F.col("StockTurnover").isNotNull())
        .groupBy(*NAME_KEYS)
        .agg(
            sum_or_zero("TotalSalesQuantity", MONEY).alias("units"),
            sum_or_zero("AverageInventoryUnits").alias("stock"),
        )
        .select(*NAME_KEYS, ratio("units", "stock").alias("AvgStockTurnOver"))
    )


def brand_margins(summary: DataFrame) -> DataFrame:
    grouped = summary.groupBy("Brand", "Description").agg(
        sum_or_zero("TotalSalesDollars", MONEY).alias("TotalSales"),
        sum_or_null("CostCoveredSalesDollars", MONEY).alias("covered"),
        sum_or_null("GrossProfit").alias("profit"),
    )
    return grouped.select(
        "Brand",
        "Description",
        "TotalSales",
        ratio("profit", "covered", 100.0).alias("AvgProfitMargin"),
    )


def target_flag(brands: DataFrame, sales: str, margin: str, positive_only: bool) -> DataFrame:
    """Mark rows with low sales (15th percentile) and a high margin (85th percentile)."""
    base = F.when(F.col(sales) > 0, F.col(sales)) if positive_only else F.col(sales)
    cuts = quantiles(
        brands.select(base.alias("s"), F.col(margin).alias("m")),
        {"_low_sales": ("s", 0.15), "_high_margin": ("m", 0.85)},
    )
    return (
        with_scalars(brands, cuts)
        .withColumn(
            "TargetBrand",
            F.coalesce(
                (F.col(sales) <= F.col("_low_sales")) & (F.col(margin) >= F.col("_high_margin")),
                F.lit(False),
            ),
        )
        .withColumnsRenamed(
            {"_low_sales": "LowSalesThreshold", "_high_margin": "HighMarginThreshold"}
        )
    )


def brand_performance(summary: DataFrame) -> DataFrame:
    """Sales and margin per brand, marking low-sales, high-margin targets."""
    brands = hold(brand_margins(summary), "brand_margins")
    return target_flag(brands, "TotalSales", "AvgProfitMargin", True).drop(
        "LowSalesThreshold", "HighMarginThreshold"
    )
