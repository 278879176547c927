"""Procurement planning risk: flags, their count and the recommended attention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import holds, money
from ..functions.frames import with_scalars
from ..functions.ranking import quantiles
from .leadtime import DAYS, portfolio_lead_times

# Thresholds, flags that count, and recommendation labels.
LOW_MATCH_RATE_PCT = 70
CONCENTRATION_PCT = 5
COUNTED_FLAGS = (
    "HighLeadTimeRisk", "LeadTimeConsistencyRisk", "DeliveryReconciliationRisk",
    "PriceVarianceRisk", "InventoryExposureRisk", "POAgingRisk",
)
ATTENTION_STATUSES = ("Underperforming", "Watchlist")
PRIORITIZE, MONITOR, MAINTAIN = "Prioritize procurement review", "Monitor", "Maintain"

# Columns taken over from the scorecard, and the output order.
CARRIED_COLUMNS = (
    "VendorNumber", "VendorName", "TotalPurchaseDollars", "PurchaseContributionPct",
    "MedianLeadTimeDays", "LeadTimeStdDevDays", "LeadTimeVarianceDays", "InvoiceMatchRatePct",
    "QuantityAlignmentRatePct", "AbsoluteAvgPriceVariancePct", "EligibleInventoryTurnover",
    "EstimatedEndingInventoryCost", "SupplierPerformanceScore", "PerformanceStatus",
    "ObservedLeadTimeOrderCount", "MatchedPOCount", "PurchaseOrderKeyCount",
)
OUTPUT_COLUMNS = (
    *CARRIED_COLUMNS,
    "HighLeadTimeRisk", "LeadTimeConsistencyRisk", "DeliveryReconciliationRisk",
    "PriceVarianceRisk", "HighSpendConcentrationFlag", "InventoryExposureRisk",
    "HighCycleTimePOCount", "POAgingRisk", "RiskFlagCount", "SupplierConcentrationPct",
    "PortfolioMedianLeadTimeDays", "RecommendedAttention",
)


def high_cycle_counts(orders: DataFrame) -> DataFrame:
    """Orders per vendor number at or above the portfolio's third quartile.

    Counted from (vendor, days) totals, so a dominant vendor is combined before the shuffle.
    """
    per_day = (
        orders.where(F.col(DAYS).isNotNull() & F.col("VendorNumber").isNotNull())
        .groupBy("VendorNumber", DAYS)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    portfolio = portfolio_lead_times(orders).select("Q3Days")
    return (
        with_scalars(per_day, portfolio)
        .where(F.col(DAYS) >= F.col("Q3Days"))
        .groupBy("VendorNumber")
        .agg(F.sum("n").alias("HighCycleTimePOCount"))
    )


def planning_risk(performance: DataFrame, orders: DataFrame) -> DataFrame:
    """One risk row per scorecard row. ``performance`` and ``orders`` are read several times."""
    base = performance.select(*CARRIED_COLUMNS)
    portfolio = portfolio_lead_times(orders).select("Q3Days", "MedianDays", "StdDays")
    medians = quantiles(
        base,
        {
            "_price": ("AbsoluteAvgPriceVariancePct", 0.5),
            "_stock": ("EstimatedEndingInventoryCost", 0.5),
        },
    )
    spend = base.agg(F.sum(money("TotalPurchaseDollars")).cast("double").alias("_spend"))
    framed = with_scalars(with_scalars(with_scalars(base, portfolio), medians), spend)
    flagged = framed.join(high_cycle_counts(orders), "VendorNumber", "left").select(
        *framed.columns,
        F.coalesce("HighCycleTimePOCount", F.lit(0)).alias("HighCycleTimePOCount"),
        holds(F.col("MedianLeadTimeDays") > F.col("Q3Days")).alias("HighLeadTimeRisk"),
        holds(F.col("LeadTimeStdDevDays") > F.col("StdDays")).alias("LeadTimeConsistencyRisk"),
        holds(F.col("InvoiceMatchRatePct") < LOW_MATCH_RATE_PCT).alias(
            "DeliveryReconciliationRisk"
        ),
        holds(F.col("AbsoluteAvgPriceVariancePct") > F.col("_price")).alias("PriceVarianceRisk"),
        holds(F.col("PurchaseContributionPct") >= CONCENTRATION_PCT).alias(
            "HighSpendConcentrationFlag"
        ),
        holds(F.col("EstimatedEndingInventoryCost") > F.col("_stock")).alias(
            "InventoryExposureRisk"
        ),
        holds(F.col("HighCycleTimePOCount") > 0).alias("POAgingRisk"),
        F.when(
            F.col("_spend") != 0,
            F.try_divide(F.col("TotalPurchaseDollars"), F.col("_spend")) * 100,
        ).alias("SupplierConcentrationPct"),
        F.col("MedianDays").alias("PortfolioMedianLeadTimeDays"),
    )
    count = F.lit(0)
    for flag in COUNTED_FLAGS:
        count = count + F.col(flag)
    counted = flagged.withColumn("RiskFlagCount", count)
    urgent = (
        F.col("PerformanceStatus").isin(*ATTENTION_STATUSES)
        | (F.col("RiskFlagCount") >= 3)
        | ((F.col("HighSpendConcentrationFlag") == 1) & (F.col("RiskFlagCount") >= 2))
    )
    return counted.withColumn(
        "RecommendedAttention",
        F.when(urgent, PRIORITIZE).when(F.col("RiskFlagCount") >= 1, MONITOR).otherwise(MAINTAIN),
    ).select(*OUTPUT_COLUMNS)
