"""Exploratory queries on the source tables and on the vendor-brand summary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (
    MONEY,
    currency_label,
    exact_mean,
    fine,
    half_even,
    money,
    ratio,
    strip_whitespace,
    sum_or_zero,
)
from ..functions.frames import with_scalars
from ..functions.ranking import running_sum
from ..functions.workspace import hold
from .vendors import target_flag


def vendor_rows(df: DataFrame, vendor: int, column: str = "VendorNumber") -> DataFrame:
    """All rows of one vendor; the equality reaches the scan."""
    return df.where(F.col(column) == vendor)


def profitable(summary: DataFrame) -> DataFrame:
    """Rows with a positive margin, profit and sales quantity."""
    return summary.where("ProfitMargin > 0 AND GrossProfit > 0 AND TotalSalesQuantity > 0")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def brand_price_totals(purchases: DataFrame) -> DataFrame:
    """Quantity and dollars per brand and unit price."""
    return (
        purchases.where(F.col("Brand").isNotNull() & F.col("PurchasePrice").isNotNull())
        .groupBy("Brand", "PurchasePrice")
        .agg(
            F.coalesce(F.sum("Quantity"), F.lit(0)).alias("Quantity"),
            F.coalesce(F.sum(money("Dollars")).cast("double"), F.lit(0.0)).alias("Dollars"),
        )
    )


def brand_sales_totals(sales: DataFrame) -> DataFrame:
    """Dollars, prices and quantity per brand sold."""
    return (
        sales.where(F.col("Brand").isNotNull())
        .groupBy("Brand")
        .agg(
            F.coalesce(F.sum(money("SalesDollars")).cast("double"), F.lit(0.0)).alias("SalesDollars"),
            F.coalesce(F.sum(money("SalesPrice")).cast("double"), F.lit(0.0)).alias("SalesPrice"),
            F.coalesce(F.sum("SalesQuantity"), F.lit(0)).alias("SalesQuantity"),
        )
    )


def purchases_with_reference(purchases: DataFrame, prices: DataFrame) -> DataFrame:
    """Purchases per vendor, brand and spelling, next to the largest reference values.

    A pair with several reference rows repeats its purchases in a plain join; here the
    price rows are counted first and the sums scaled, which gives the same totals without
    multiplying the raw rows.
    """
    costed = (F.col("PurchasePrice") > 0) & (F.col("Quantity") > 0)
    bought = purchases.groupBy("VendorNumber", "VendorName", "Brand", "Description").agg(
        F.sum("Quantity").alias("q"),
        F.sum(money("Dollars")).alias("d"),
        F.sum(F.when(costed, F.col("Quantity") * money("PurchasePrice"))).alias("c"),
        F.sum(F.when(costed, F.col("Quantity"))).alias("cq"),
    )
    reference = (
        prices.groupBy("VendorNumber", "Brand", "Volume")
        .agg(F.count(F.lit(1)).alias("n"), F.max("Price").alias("Price"))
        .groupBy("VendorNumber", "Brand")
        .agg(
            F.sum("n").alias("copies"),
            F.max("Volume").alias("Volume"),
            F.max("Price").alias("ReferencePrice"),
        )
    )
    copies = F.coalesce("copies", F.lit(1))
    return bought.join(reference, ["VendorNumber", "Brand"], "left").select(
        "VendorNumber",
        "VendorName",
        "Brand",
        "Description",
        (F.col("q") * copies).alias("TotalPurchaseQuantity"),
        (F.col("d") * copies).cast("double").alias("TotalPurchaseDollars"),
        F.try_divide(F.col("c").cast("double"), F.col("cq").cast("double")).alias(
            "WeightedPurchasePrice"
        ),
        "Volume",
        "ReferencePrice",
    ).orderBy(
        F.desc("TotalPurchaseDollars"), "VendorNumber", "VendorName", "Brand", "Description"
    )


def sales_by_vendor_brand(sales: DataFrame) -> DataFrame:
    """Plain sales sums per vendor and brand, smallest first."""
    return (
        sales.groupBy("VendorNo", "Brand")
        .agg(
            F.sum(money("SalesDollars")).cast("double").alias("TotalSalesDollars"),
            F.sum(money("SalesPrice")).cast("double").alias("TotalSalesPrice"),
            F.sum("SalesQuantity").alias("TotalSalesQuantity"),
            F.sum(money("ExciseTax")).cast("double").alias("TotalExciseTax"),
        )
        .orderBy("TotalSalesDollars", "VendorNo", "Brand")
    )


def description_performance(rows: DataFrame) -> DataFrame:
    """Sales and mean margin per product description."""
    return (
        rows.where(F.col("Description").isNotNull())
        .groupBy("Description")
        .agg(
            sum_or_zero("TotalSalesDollars", MONEY).alias("TotalSalesDollars"),
            exact_mean(F.col("ProfitMargin")).alias("ProfitMargin"),
        )
    )


def description_targets(rows: DataFrame) -> DataFrame:
    """Every description with the low-sales and high-margin cuts and the target mark."""
    brands = hold(description_performance(rows), "description_performance")
    return target_flag(brands, "TotalSalesDollars", "ProfitMargin", False)


def target_brands(rows: DataFrame) -> DataFrame:
    """Descriptions with low sales and a high margin, the smallest sales first."""
    return (
        description_targets(rows)
        .where("TargetBrand")
        .select("Description", "TotalSalesDollars", "ProfitMargin")
        .orderBy("TotalSalesDollars", "Description")
    )


def target_scatter(rows: DataFrame, limit: float = 10_000.0) -> DataFrame:
    """Scatter points up to a sales limit, plus every target."""
    return description_targets(rows).where(
        (F.col("TotalSalesDollars") <= limit) | F.col("TargetBrand")
    )


def top_by_sales(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Largest sales totals of a name column, with their compact label."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(sum_or_zero("TotalSalesDollars", MONEY).alias("TotalSalesDollars"))
        .orderBy(F.desc("TotalSalesDollars"), column)
        .limit(n)
        .withColumn("Label", currency_label("TotalSalesDollars"))
    )


def vendor_name_shares(rows: DataFrame) -> DataFrame:
    """Purchases, profit and sales per vendor name with the share of purchases (two decimals)."""
    names = hold(
        rows.where(F.col("VendorName").isNotNull())
        .groupBy("VendorName")
        .agg(
            sum_or_zero("TotalPurchaseDollars", MONEY).alias("p"),
            sum_or_zero("GrossProfit").alias("g"),
            sum_or_zero("TotalSalesDollars", MONEY).alias("s"),
        ),
        "vendor_names",
    )
    total = names.agg(F.sum(fine("p")).cast("double").alias("_all"))
    return with_scalars(names, total).select(
        "VendorName",
        half_even("p").alias("TotalPurchaseDollars"),
        half_even("g").alias("GrossProfit"),
        half_even("s").alias("TotalSalesDollars"),
        half_even(F.try_divide(F.col("p"), F.col("_all")) * 100).alias("PurchaseContributionPct"),
        (F.try_divide(F.col("p"), F.col("_all")) * 100).alias("_exact"),
    )


def pareto(rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest vendors by purchase share with labels and the running share.

    The running share adds the rounded shares, from the largest exact share down.
    """
    top = vendor_name_shares(rows).orderBy(F.desc_nulls_last("_exact"), "VendorName").limit(n)
    share = F.col("PurchaseContributionPct").cast("decimal(18,2)")
    running = running_sum(top, [-F.col("_exact"), F.col("VendorName")], share, "running")
    return running.select(
        "VendorName",
        currency_label("TotalPurchaseDollars").alias("TotalPurchaseDollars"),
        currency_label("GrossProfit").alias("GrossProfit"),
        currency_label("TotalSalesDollars").alias("TotalSalesDollars"),
        "PurchaseContributionPct",
        F.col("running").cast("double").alias("CumulativeContributionPct"),
    )


def top_and_others(rows: DataFrame, n: int = 10) -> DataFrame:
    """Shares of the ``n`` largest vendors and of everyone else."""
    top = (
        vendor_name_shares(rows)
        .orderBy(F.desc_nulls_last("_exact"), "VendorName")
        .limit(n)
        .select(
            F.col("VendorName").alias("Vendor"),
            F.col("PurchaseContributionPct").cast("decimal(18,2)").alias("share"),
        )
    )
    rest = top.agg(
        F.lit("OTHERS").alias("Vendor"),
        (F.lit(100) - F.coalesce(F.sum("share"), F.lit(0))).alias("share"),
    )
    return top.unionByName(rest).select("Vendor", F.col("share").cast("double").alias("SharePct"))


def order_lines(purchases: DataFrame) -> DataFrame:
    """Quantity and weighted price per vendor, brand and order; only orders with a price."""
    priced = F.col("PurchasePrice") > 0
    return (
        purchases.groupBy("VendorNumber", "Brand", "PONumber")
        .agg(
            F.sum("Quantity").alias("OrderQuantity"),
            F.sum(F.when(priced, F.col("Quantity") * money("PurchasePrice"))).alias("c"),
            F.sum(F.when(priced, F.col("Quantity"))).alias("cq"),
        )
        .where("cq > 0")
        .select(
            "VendorNumber", "Brand", "PONumber", "OrderQuantity",
            F.try_divide(F.col("c").cast("double"), F.col("cq").cast("double")).alias(
                "PurchasePrice"
            ),
        )
    )


def slow_vendors(rows: DataFrame, n: int = 10) -> DataFrame:
    """Vendors by the mean turnover of their slow brands (below one), slowest first."""
    return (
        rows.where((F.col("StockTurnover") < 1) & F.col("VendorName").isNotNull())
        .groupBy("VendorName")
        .agg(exact_mean(F.col("StockTurnover")).alias("StockTurnover"))
        .orderBy("StockTurnover", "VendorName")
        .limit(n)
    )


def inventory_cost_ranking(performance: DataFrame) -> DataFrame:
    """Vendors by estimated ending inventory cost, unknown costs last."""
    return performance.select(
        "VendorNumber", "VendorName", "EstimatedEndingInventoryCost",
        "EligibleInventoryBrandCount",
    ).orderBy(F.desc_nulls_last("EstimatedEndingInventoryCost"), "VendorNumber", "VendorName")


def vendor_margins(rows: DataFrame) -> DataFrame:
    """Margin per vendor from summed profit over summed sales."""
    return (
        rows.where(F.col("VendorNumber").isNotNull() & F.col("VendorName").isNotNull())
        .groupBy("VendorNumber", "VendorName")
        .agg(
            sum_or_zero("TotalSalesDollars", MONEY).alias("TotalSalesDollars"),
            sum_or_zero("GrossProfit").alias("GrossProfit"),
        )
        .withColumn("ProfitMargin", ratio("GrossProfit", "TotalSalesDollars", 100.0))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-NULL rows and NULL rows, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("ColumnName"),
                F.lit(t).alias("DataType"),
                F.col(f"n{i}").alias("NonNullCount"),
                (F.col("_rows") - F.col(f"n{i}")).alias("NullCount"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return counted.select(F.explode(cells).alias("cell")).select("cell.*")


def untrimmed_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: values whose length changes when white space is stripped.

    A NULL has no length, so it counts as not clean.
    """
    counts = df.agg(
        *[
            F.count_if(
                F.coalesce(F.length(c) != F.length(strip_whitespace(c)), F.lit(True))
            ).alias(c)
            for c in columns
        ]
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("Untrimmed")) for c in columns]
    )
    return counts.select(F.explode(cells).alias("cell")).select("cell.*")


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip_whitespace(c) for c in columns})


def fill_numbers(df: DataFrame) -> DataFrame:
    """NULL numbers become 0; text stays as it is."""
    return df.fillna(0)


def category_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values of a column."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("Rows"))
        .orderBy(F.desc("Rows"), column)
        .limit(n)
    )


def _first_values(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """(column, v): of each column's values that are not empty, the first ``rows`` by (order, value).

    One scan for all columns. A task keeps ``rows`` candidates of each column, whatever it reads; what
    the tasks keep is cut down again before and after the one shuffle.
    """
    keys = [f"o{i}" for i in range(len(order))]
    texts = df.select(
        *[F.col(f"`{o}`").alias(k) for k, o in zip(keys, order, strict=True)],
        *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    columns = [f"c{i}" for i in range(len(df.columns))]
    kinds = ", ".join(f"{k} {dict(texts.dtypes)[k]}" for k in keys)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, pa.Table] = {}
        for batch in table:
            rows_ = pa.Table.from_batches([batch])
            # NULL comes first
            known = {f"{k}_known": pc.is_valid(rows_[k]) for k in keys}
            for c in columns:
                found = pa.table({**{k: rows_[k] for k in keys}, **known, "v": rows_[c]})
                found = found.filter(pc.fill_null(pc.not_equal(found["v"], ""), False))
                if c in best:
                    found = pa.concat_tables([best[c], found])
                if found.num_rows > rows:
                    by = [(x, "ascending") for k in keys for x in (f"{k}_known", k)] + [("v", "ascending")]
                    found = found.take(pc.select_k_unstable(found, rows, by))
                best[c] = found.combine_chunks()
        for i, c in enumerate(columns):
            if c in best and best[c].num_rows:
                number = pa.array([i] * best[c].num_rows, pa.int32())
                yield from best[c].select([*keys, "v"]).add_column(0, "number", number).to_batches()

    kept = texts.mapInArrow(run, f"number int, {kinds}, v string")
    place = F.row_number().over(W.partitionBy("number").orderBy(*keys, "v"))
    names = F.array(*[F.lit(c) for c in df.columns])
    return kept.withColumn("place", place).where(F.col("place") <= rows).select(names[F.col("number")].alias("column"), "v")


def type_profile(df: DataFrame, order: Sequence[str], rows: int = 30) -> DataFrame:
    """Guess each column's type from its first ``rows`` non-empty values, as text.

    A column is numeric when more than four in five of them parse as a number. A column without any
    value is text.
    """
    found = _first_values(df, order, rows).groupBy("column").agg(
        F.count("v").alias("Sampled"), F.count_if(F.trim("v").try_cast("double").isNotNull()).alias("Numeric")
    )
    every = df.sparkSession.createDataFrame([(c,) for c in df.columns], "ColumnName string")
    sampled, numeric = (F.coalesce(c, F.lit(0)) for c in ("Sampled", "Numeric"))
    return every.join(found, F.col("ColumnName") == F.col("column"), "left").select(
        "ColumnName", sampled.alias("Sampled"), numeric.alias("Numeric"),
        F.when(numeric > sampled * 0.8, "DOUBLE").otherwise("STRING").alias("DataType"),
    )
