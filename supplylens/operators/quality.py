"""Guards: grain uniqueness and reconciliation against raw totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money, within
from ..functions.frames import with_scalars


class DataQualityError(ValueError):
    """A table breaks a rule it must keep."""


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys included, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Rows")).where("Rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Return ``df`` after checking that ``keys`` identify its rows."""
    found = repeated_keys(df, keys).limit(3).collect()
    if found:
        raise DataQualityError(f"{what} is not unique by {list(keys)}: {found}")
    return df


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys, keys that repeat, and rows beyond the first of their key."""
    return repeat_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def repeat_counts(sizes: DataFrame) -> DataFrame:
    """The same from the rows of each key, ``n``."""
    return sizes.agg(
        F.count(F.lit(1)).alias("DistinctKeys"),
        F.count_if(F.col("n") > 1).alias("RepeatedKeys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("SurplusRows"),
    )


def is_key(df: DataFrame, column: str) -> DataFrame:
    """One row: does the column take a different value in every row?"""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Rows"),
        F.count(column).alias("DistinctValues"),
    ).withColumn("IsUnique", F.col("Rows") == F.col("DistinctValues"))


def summary_reconciliation(summary: DataFrame, purchases: DataFrame, sales: DataFrame) -> DataFrame:
    """Summary totals against raw totals: one row per measure.

    A measure without any raw value (NULL total) counts as reconciled.
    """
    measures = {
        "TotalPurchaseDollars": "_pd",
        "TotalPurchaseQuantity": "_pq",
        "TotalSalesDollars": "_sd",
        "TotalSalesQuantity": "_sq",
    }
    bought = purchases.agg(
        F.sum(money("Dollars")).cast("double").alias("_pd"),
        F.sum("Quantity").cast("double").alias("_pq"),
    )
    sold = sales.agg(
        F.sum(money("SalesDollars")).cast("double").alias("_sd"),
        F.sum("SalesQuantity").cast("double").alias("_sq"),
    )
    totals = summary.agg(
        *[F.coalesce(F.sum(money(m)).cast("double"), F.lit(0.0)).alias(m) for m in measures]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("Measure"),
                F.col(m).alias("SummaryTotal"),
                F.col(raw).alias("RawTotal"),
            )
            for m, raw in measures.items()
        ]
    )
    return (
        with_scalars(with_scalars(totals, bought), sold)
        .select(F.explode(rows).alias("r"))
        .select("r.*")
        .withColumn("Reconciles", F.coalesce(within("SummaryTotal", "RawTotal", 0.01), F.lit(True)))
    )


def assert_reconciles(checks: DataFrame) -> None:
    broken = checks.where(~F.col("Reconciles")).collect()
    if broken:
        raise DataQualityError(f"summary does not reconcile to its raw source: {broken}")
