"""Observed lead times: portfolio, supplier and brand level.

Lead times are whole days, so every statistic is computed from day counts: one hash
aggregate shrinks the orders to (group, days) and exact integer moments, medians and
extremes follow from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import holds, money, sample_variance, trim_spaces
from ..functions.frames import aggregate_with_labels, merge_inner, with_scalars

# Columns of the lead-time fact.
DETAIL_COLUMNS = (
    "VendorNumber", "VendorName", "PONumber", "PODate", "LastReceivingDate",
    "ObservedLeadTimeDays", "PurchaseDollars", "POCycleAgingBucket",
)
DAYS = "ObservedLeadTimeDays"


def _moments():
    n, d = F.col("n"), F.col(DAYS).cast("long")
    return {"_n": F.sum("n"), "_s": F.sum(d * n), "_q": F.sum(d * d * n)}


def portfolio_lead_times(orders: DataFrame) -> DataFrame:
    """One row: count, mean, median, deviation and quartiles over all observed orders."""
    days = (
        orders.where(F.col(DAYS).isNotNull()).groupBy(DAYS).agg(F.count(F.lit(1)).alias("n"))
    )
    m = _moments()
    stats = days.agg(
        F.coalesce(m["_n"], F.lit(0)).alias("Orders"),
        F.try_divide(m["_s"].cast("double"), m["_n"].cast("double")).alias("MeanDays"),
        F.percentile(DAYS, [0.25, 0.5, 0.75], F.col("n")).alias("_p"),
        F.sqrt(sample_variance(m["_n"], m["_s"], m["_q"])).alias("StdDays"),
    )
    return stats.select(
        "Orders",
        "MeanDays",
        F.col("_p")[0].alias("Q1Days"),
        F.col("_p")[1].alias("MedianDays"),
        F.col("_p")[2].alias("Q3Days"),
        "StdDays",
    )


def lead_time_detail(orders: DataFrame) -> DataFrame:
    """Observed orders with the portfolio figures and the 1.5 IQR outlier flag."""
    observed = orders.where(F.col(DAYS).isNotNull()).select(*DETAIL_COLUMNS)
    fenced = with_scalars(observed, portfolio_lead_times(orders))
    margin = (F.col("Q3Days") - F.col("Q1Days")) * 1.5
    outside = (F.col(DAYS) < F.col("Q1Days") - margin) | (F.col(DAYS) > F.col("Q3Days") + margin)
    return fenced.select(
        *DETAIL_COLUMNS,
        holds(outside).alias("LeadTimeOutlierFlag"),
        F.col("MedianDays").alias("PortfolioMedianLeadTimeDays"),
        F.col("MeanDays").alias("PortfolioMeanLeadTimeDays"),
        F.col("StdDays").alias("PortfolioStdLeadTimeDays"),
        (F.col(DAYS) - F.col("MedianDays")).alias("LeadTimeVsMedianDays"),
    )


def supplier_lead_times(detail: DataFrame) -> DataFrame:
    """Lead-time statistics per supplier name; PO numbers are unique per supplier."""
    days = detail.groupBy("VendorNumber", "VendorName", DAYS, "LeadTimeOutlierFlag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("PONumber").alias("orders"),
        F.sum(money("PurchaseDollars")).alias("spend"),
    )
    m = _moments()
    variance = sample_variance(m["_n"], m["_s"], m["_q"])
    grouped = days.groupBy("VendorNumber", "VendorName").agg(
        F.sum("orders").alias("ObservedLeadTimeOrderCount"),
        F.try_divide(m["_s"].cast("double"), m["_n"].cast("double")).alias("AverageLeadTimeDays"),
        F.percentile(DAYS, 0.5, F.col("n")).alias("MedianLeadTimeDays"),
        F.min(DAYS).cast("double").alias("MinLeadTimeDays"),
        F.max(DAYS).cast("double").alias("MaxLeadTimeDays"),
        F.sqrt(variance).alias("LeadTimeStdDevDays"),
        variance.alias("LeadTimeVarianceDays"),
        F.sum(F.col("LeadTimeOutlierFlag") * F.col("n")).alias("OutlierLeadTimeOrderCount"),
        F.coalesce(F.sum("spend").cast("double"), F.lit(0.0)).alias("LeadTimePurchaseSpend"),
    )
    return grouped.withColumn(
        "LeadTimeConsistencyScore",
        1 / (1 + F.coalesce(F.col("LeadTimeStdDevDays"), F.lit(0.0))),
    )


def brand_lead_times(purchases: DataFrame, orders: DataFrame) -> DataFrame:
    """Lead times per brand over its distinct vendor-PO pairs.

    The orders are joined once per brand line; the order count is of distinct PO numbers. Days, PO
    numbers and vendors of a brand are counted by one grouping of the joined lines.
    """
    lines = aggregate_with_labels(
        purchases,
        ["VendorNumber", "PONumber", "Brand"],
        {"Description": trim_spaces("Description")},
        {"n": F.count(F.lit(1))},
        {"n": F.sum("n")},
    ).where("n > 0").drop("n")  # always so; the count keeps the grouping by spelling in the plan
    observed = orders.where(F.col(DAYS).isNotNull()).select("VendorNumber", "PONumber", DAYS)
    joined = merge_inner(lines, observed, ["VendorNumber", "PONumber"])
    keys = ["Brand", "Description"]
    counted = joined.groupingSets(
        [[*keys, DAYS], [*keys, "PONumber"], [*keys, "VendorNumber"]], *keys, DAYS, "PONumber", "VendorNumber"
    ).agg(F.count(F.lit(1)).alias("n"))
    # a grouping that leaves a column out gives NULL for it, and an observed order has its days
    per_day = counted.withColumn("n", F.when(F.col(DAYS).isNotNull(), F.col("n")))
    m = _moments()
    variance = sample_variance(m["_n"], m["_s"], m["_q"])
    return per_day.groupBy(*keys).agg(
        F.count("PONumber").alias("ObservedLeadTimeOrderCount"),
        F.try_divide(m["_s"].cast("double"), m["_n"].cast("double")).alias("AverageLeadTimeDays"),
        F.percentile(DAYS, 0.5, F.coalesce("n", F.lit(0))).alias("MedianLeadTimeDays"),
        F.sqrt(variance).alias("LeadTimeStdDevDays"),
        variance.alias("LeadTimeVarianceDays"),
        F.count("VendorNumber").alias("PurchasingVendorCount"),
    )
