"""Supplier scorecard: composite score and performance status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import exact_mean
from ..functions.frames import merge, merge_left, with_scalars
from ..functions.ranking import percent_ranks, quantiles_of, ranks_in, with_range
from ..functions.workspace import hold
from .vendors import NAME_KEYS

# Score parts with their direction, minimum evidence, status labels, note.
SCORE_PARTS = {
    "LeadTimeConsistencyScore": True,
    "InvoiceMatchRatePct": True,
    "QuantityAlignmentRatePct": True,
    "AbsoluteAvgPriceVariancePct": False,
    "MedianLeadTimeDays": False,
}
LEAST_ORDERS = 5
STATUS_LEVELS = (
    ("High Performing", "ScoreThresholdP75", 0.75),
    ("Stable / Acceptable", "ScoreThresholdP25", 0.25),
    ("Watchlist", "ScoreThresholdP10", 0.10),
)
LOWEST_STATUS, NO_STATUS = "Underperforming", "Insufficient data"
OTIF_NOTE = (
    "Source data has no promised delivery date and no distinct ordered quantity; "
    "OTIF/On-Time/In-Full cannot be calculated. Use InvoiceMatchRatePct and "
    "QuantityAlignmentRatePct as delivery-reconciliation proxies."
)


def price_variance(summary: DataFrame) -> DataFrame:
    """Per supplier name: brands with a reference price, mean and mean absolute variance."""
    return summary.groupBy(*NAME_KEYS).agg(
        F.count("ReferencePurchasePrice").alias("BrandsWithReferencePrice"),
        exact_mean(F.col("PurchasePriceVariancePct")).alias("AveragePurchasePriceVariancePct"),
        exact_mean(F.abs("PurchasePriceVariancePct")).alias("AbsoluteAvgPriceVariancePct"),
    )


def scorecard_base(
    performance: DataFrame, lead_times: DataFrame, delivery: DataFrame, summary: DataFrame
) -> DataFrame:
    """Vendor performance with its lead-time, delivery and price figures.

    Each join must be one to one by supplier number and name, and fails if it is not.
    """
    return merge(performance, [lead_times, delivery, price_variance(summary)], NAME_KEYS, "left", one_to_one=True)


def composite_scores(base: DataFrame) -> DataFrame:
    """Mean of a supplier's available percent ranks, as a percentage, per supplier name.

    The ranks compare all suppliers; only those with enough observed orders get a score.
    """
    evidence = base.select(*NAME_KEYS, "ObservedLeadTimeOrderCount")
    ranks = merge_left(evidence, percent_ranks(base, NAME_KEYS, SCORE_PARTS), NAME_KEYS)
    total, known = F.lit(0.0), F.lit(0)
    for part in SCORE_PARTS:
        total = total + F.coalesce(F.col(part), F.lit(0.0))
        known = known + F.col(part).isNotNull().cast("int")
    enough = F.coalesce(F.col("ObservedLeadTimeOrderCount"), F.lit(0)) >= LEAST_ORDERS
    score = F.when(enough & (known > 0), total / known * 100)
    return ranks.select(*NAME_KEYS, score.alias("SupplierPerformanceScore"))


def performance_status(scored: DataFrame) -> DataFrame:
    """Status by the portfolio's own score percentiles, which are kept as columns.

    The scores are written once, in order, which gives the percentiles too.
    """
    columns = scored.columns
    scored = with_range(scored, ["SupplierPerformanceScore", *NAME_KEYS], "scores")
    cuts = quantiles_of(
        ranks_in(scored, "SupplierPerformanceScore"),
        {name: ("SupplierPerformanceScore", p) for _, name, p in STATUS_LEVELS},
    )
    score = F.col("SupplierPerformanceScore")
    status = F.when(score.isNull(), NO_STATUS)
    for label, threshold, _ in STATUS_LEVELS:
        status = status.when(score >= F.col(threshold), label)
    out = with_scalars(scored, cuts).withColumn(
        "PerformanceStatus", status.otherwise(LOWEST_STATUS)
    )
    names = [name for _, name, _ in STATUS_LEVELS]
    return out.select(*columns, "PerformanceStatus", *names)


def supplier_performance(
    performance: DataFrame, lead_times: DataFrame, delivery: DataFrame, summary: DataFrame
) -> DataFrame:
    """The full scorecard. On-time and in-full rates stay NULL: the data cannot give them."""
    base = hold(scorecard_base(performance, lead_times, delivery, summary), "scorecard")
    rated = merge_left(base.drop("OTIFSupported"), performance_status(composite_scores(base)), NAME_KEYS)
    return rated.select(
        "*",
        F.lit(None).cast("double").alias("OTIFPct"),
        F.lit(None).cast("double").alias("OnTimePct"),
        F.lit(None).cast("double").alias("InFullPct"),
        F.lit(False).alias("OTIFSupported"),
        F.lit(OTIF_NOTE).alias("OTIFLimitationNote"),
    )


