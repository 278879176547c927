"""Beginning and ending inventory snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fine, money

SNAPSHOT_COLUMNS = ("Store", "Brand", "onHand", "Price")


def snapshot(inventory: DataFrame, units: str, value: str) -> DataFrame:
    """Units and retail value per store and brand."""
    return inventory.groupBy("Store", "Brand").agg(
        F.sum("onHand").cast("double").alias(units),
        F.sum(F.col("onHand") * money("Price")).cast("double").alias(value),
    )


def _both(begin: str = "BeginningUnits", end: str = "EndingUnits") -> Column:
    return F.col(begin).isNotNull() & F.col(end).isNotNull()


def inventory_position(begin: DataFrame, end: DataFrame) -> DataFrame:
    """Every store-brand position of either snapshot (full outer on store and brand)."""
    b = snapshot(begin, "BeginningUnits", "BeginningRetailValue").alias("b")
    e = snapshot(end, "EndingUnits", "EndingRetailValue").alias("e")
    joined = b.join(
        e,
        (F.col("b.Store") == F.col("e.Store")) & (F.col("b.Brand") == F.col("e.Brand")),
        "full",
    )

    def available(units: str) -> Column:
        return F.when(F.col(units).isNotNull(), (F.col(units) > 0).cast("int"))

    return joined.select(
        F.coalesce("b.Store", "e.Store").alias("Store"),
        F.coalesce("b.Brand", "e.Brand").alias("Brand"),
        "BeginningUnits",
        "EndingUnits",
        "BeginningRetailValue",
        "EndingRetailValue",
        F.when(_both(), (F.col("BeginningUnits") + F.col("EndingUnits")) / 2.0).alias(
            "AverageInventoryUnits"
        ),
        available("BeginningUnits").alias("BeginningAvailable"),
        available("EndingUnits").alias("EndingAvailable"),
        _both().cast("int").alias("HasBothSnapshots"),
    )


def inventory_summary(position: DataFrame) -> DataFrame:
    """Add the low-inventory flag and the movement between the snapshots."""
    return position.select(
        "*",
        F.when(F.col("EndingUnits").isNotNull(), (F.col("EndingUnits") <= 0).cast("int")).alias(
            "LowInventoryFlag"
        ),
        F.when(_both(), F.col("EndingUnits") - F.col("BeginningUnits")).alias(
            "InventoryMovementUnits"
        ),
    )


def inventory_by_brand(position: DataFrame) -> DataFrame:
    """Per brand: positions, complete positions, and quantities over the complete ones."""
    complete = _both()
    return position.groupBy("Brand").agg(
        F.count(F.lit(1)).alias("StoreCount"),
        F.count_if(complete).alias("CompleteStoreCount"),
        F.sum(F.when(complete, fine("AverageInventoryUnits")))
        .cast("double")
        .alias("AverageInventoryUnits"),
        F.sum(F.when(complete, fine("EndingUnits"))).cast("double").alias("EndingInventoryUnits"),
        F.sum(F.when(complete, money("EndingRetailValue")))
        .cast("double")
        .alias("EndingInventoryRetailValue"),
    )
