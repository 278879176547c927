"""Descriptive and inferential statistics behind the plots.

Everything is computed from value frequencies, so repeated values cost one row and no
column is ever ordered in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import with_scalars
from ..functions.ranking import frequencies, long_form, quantile, thirds, value_ranks
from ..functions.workspace import hold

ORDER_SIZES = ("Small", "Medium", "Large")
SALES_GROUPS = ("Top", "Low")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of every column, one row each."""
    ranks = value_ranks(df, columns)
    v, n = F.col("value"), F.col("ties")
    mean = ranks.groupBy("metric").agg(
        F.sum(n).alias("count"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min(v).alias("min"),
        quantile(0.25).alias("p25"),
        quantile(0.5).alias("p50"),
        quantile(0.75).alias("p75"),
        F.max(v).alias("max"),
    )
    spread = long_form(df, columns).groupBy("metric").agg(F.stddev_samp("value").alias("std"))
    return mean.join(spread, "metric").select(
        F.col("metric").alias("ColumnName"),
        "count", "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's extremes; the last bin is closed."""
    freq = hold(frequencies(df, columns), "frequencies")
    span = freq.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        "metric",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        freq.join(F.broadcast(span), "metric")
        .groupBy("metric", F.least(place, F.lit(bins - 1)).cast("int").alias("Bin"))
        .agg(F.sum("ties").alias("n"))
    )
    grid = span.select(
        "metric", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("Bin")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["metric", "Bin"], "left").select(
        F.col("metric").alias("ColumnName"),
        "Bin",
        (F.col("lo") + width * F.col("Bin")).alias("LowerEdge"),
        (F.col("lo") + width * (F.col("Bin") + 1)).alias("UpperEdge"),
        F.coalesce("n", F.lit(0)).alias("Rows"),
    )


def density(df: DataFrame, columns: Sequence[str], points: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid per column.

    The grid runs from the smallest to the largest value, and ``cut`` bandwidths beyond. Each task
    sums the kernels of its distinct values, weighted by their frequency, into one array per column,
    so a task gives as many rows as there are grid points. Columns without spread have no density.
    """
    freq = hold(frequencies(df, columns), "frequencies")
    moments = long_form(df, columns).groupBy("metric").agg(
        F.count("value").alias("n"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    )
    grids = {}
    for r in moments.where(F.col("sd") > 0).collect():  # one row per column
        h = r["sd"] * float(r["n"]) ** -0.2
        start = r["lo"] - h * cut
        grids[r["metric"]] = (r["n"], h, start + np.arange(points) * ((r["hi"] - r["lo"] + h * (2 * cut)) / (points - 1)))

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {metric: np.zeros(points) for metric in grids}
        for batch in table:
            metrics = np.array(batch.column("metric").to_pylist())
            values, ties = batch.column("value").to_numpy(), batch.column("ties").to_numpy()
            for metric, (_, h, xs) in grids.items():
                at = np.flatnonzero(metrics == metric)
                for lo in range(0, len(at), 4096):
                    part = at[lo : lo + 4096]
                    z = (xs[:, None] - values[part]) / h
                    sums[metric] += np.exp(z * z * -0.5) @ ties[part]
        for metric, (n, h, xs) in grids.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "metric": [metric] * points, "Point": pa.array(range(points), pa.int32()), "x": xs,
                    "n": [float(n)] * points, "h": [h] * points, "k": sums[metric],
                }
            )

    spread = freq.mapInArrow(run, "metric string, Point int, x double, n double, h double, k double")
    return (
        spread.groupBy("metric", "Point")
        .agg(F.sum("k").alias("k"), F.max("x").alias("x"), F.max("n").alias("n"), F.max("h").alias("h"))
        .select(
            F.col("metric").alias("ColumnName"),
            "Point",
            F.col("x").alias("X"),
            (F.col("k") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("Density"),
        )
    )


def boxplot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (outermost values within 1.5 IQR) and outliers per column."""
    ranks = hold(value_ranks(df, columns), "ranks")
    box = ranks.groupBy("metric").agg(
        quantile(0.25).alias("Q1"), quantile(0.5).alias("Median"), quantile(0.75).alias("Q3")
    )
    return _whiskers(ranks, box, "metric").withColumnRenamed("metric", "ColumnName")


def _whiskers(ranks: DataFrame, box: DataFrame, group: str) -> DataFrame:
    low = F.col("Q1") - (F.col("Q3") - F.col("Q1")) * 1.5
    high = F.col("Q3") + (F.col("Q3") - F.col("Q1")) * 1.5
    v = F.col("value")
    inside = (v >= low) & (v <= high)
    return (
        ranks.join(F.broadcast(box), group)
        .groupBy(group, "Q1", "Median", "Q3")
        .agg(
            F.min(F.when(inside, v)).alias("LowerWhisker"),
            F.max(F.when(inside, v)).alias("UpperWhisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("ties"))), F.lit(0)).alias("Outliers"),
        )
    )


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every ordered pair of columns.

    Each task adds up the moments of all pairs as matrix products over its batches, taken about the
    columns' means, and gives one row per pair; a pair without variation is NULL.
    """
    columns = list(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    means = values.agg(*[F.avg(c).alias(c) for c in values.columns]).first()  # one row
    centre = np.array([0.0 if m is None else m for m in means])
    size = len(columns)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((5, size, size))
        for batch in table:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - centre
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            # for the pair (i, j): rows, sum of i, sum of j, sum of i * i, sum of i * j
            sums += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, x.T @ x])
        i, j = np.indices((size, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), *[pa.array(s.ravel()) for s in sums]],
            names=["i", "j", "n", "si", "sj", "sii", "sij"],
        )

    sums = ("n", "si", "sj", "sii", "sij")
    moments = values.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in sums))
    pairs = moments.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    other = pairs.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sii").alias("sjj"))
    raw_i, raw_j = F.col("n") * F.col("sii"), F.col("n") * F.col("sjj")
    vi, vj = raw_i - F.col("si") * F.col("si"), raw_j - F.col("sj") * F.col("sj")
    varied = (vi > raw_i * 1e-13) & (vj > raw_j * 1e-13)
    r = F.when(varied, (F.col("n") * F.col("sij") - F.col("si") * F.col("sj")) / (F.sqrt(vi) * F.sqrt(vj)))
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.join(other, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("ColumnA"), F.get(names, F.col("j")).alias("ColumnB"), r.alias("Correlation")
    )


def order_size_classes(lines: DataFrame) -> DataFrame:
    """Order lines in three classes of equal size by quantity."""
    order = [F.col(c) for c in ("OrderQuantity", "VendorNumber", "Brand", "PONumber")]
    return thirds(lines, order, ORDER_SIZES, "OrderSize")


def order_size_prices(classed: DataFrame) -> DataFrame:
    """Number of order lines and mean price per class."""
    return classed.groupBy("OrderSize").agg(
        F.count(F.lit(1)).alias("OrderLines"),
        F.avg("PurchasePrice").alias("PurchasePrice"),
    )


def order_size_boxplot(classed: DataFrame) -> DataFrame:
    """Box-plot figures of the price in each class: one column per class, one ranking."""
    wide = classed.select(
        *[
            F.when(F.col("OrderSize") == size, F.col("PurchasePrice")).alias(size)
            for size in ORDER_SIZES
        ]
    )
    return boxplot(wide, ORDER_SIZES).withColumnRenamed("ColumnName", "OrderSize")


def sales_groups(vendors: DataFrame) -> DataFrame:
    """Margins of the vendors in the top and the bottom quarter of sales."""
    cuts = value_ranks(vendors, ["TotalSalesDollars"]).agg(
        quantile(0.75).alias("_top"), quantile(0.25).alias("_low")
    )
    marked = with_scalars(vendors, cuts)
    sales, margin = F.col("TotalSalesDollars"), F.col("ProfitMargin")
    groups = F.array(
        F.when(sales >= F.col("_top"), "Top"), F.when(sales <= F.col("_low"), "Low")
    )
    return (
        marked.select(F.explode(F.array_compact(groups)).alias("SalesGroup"), margin)
        .where(F.col("ProfitMargin").isNotNull())
    )


def by_group(groups: DataFrame) -> DataFrame:
    """The margins of each group as a column of its own, for the column statistics."""
    margin = F.col("ProfitMargin")
    return groups.select(*[F.when(F.col("SalesGroup") == g, margin).alias(g) for g in SALES_GROUPS])


def group_moments(groups: DataFrame) -> DataFrame:
    return groups.groupBy("SalesGroup").agg(
        F.count("ProfitMargin").alias("n"),
        F.avg("ProfitMargin").alias("mean"),
        F.stddev_samp("ProfitMargin").alias("std"),
        F.var_samp("ProfitMargin").alias("var"),
    )


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300

    def keep(value: float) -> float:
        return value if abs(value) > tiny else tiny

    c, d = 1.0, 1.0 / keep(1.0 - (a + b) * x / (a + 1.0))
    h = d
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / keep(1.0 + even * d)
        c = keep(1.0 + even / c)
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / keep(1.0 + odd * d)
        c = keep(1.0 + odd / c)
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) of Student's distribution."""
    if math.isnan(t) or math.isnan(df):
        return float("nan")
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    if x <= 0.0:
        return 0.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_critical(confidence: float, df: float) -> float:
    """The t with P(|T| <= t) equal to the confidence, by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > 1.0 - confidence:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if t_two_sided(mid, df) > 1.0 - confidence:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def confidence_intervals(groups: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Mean and t interval per group; only one row per group reaches Python."""

    @F.pandas_udf("double")
    def critical(df: pd.Series) -> pd.Series:
        return df.map(lambda d: t_critical(confidence, d) if d >= 1 else float("nan"))

    m = group_moments(groups).withColumn("t", critical(F.col("n").cast("double") - 1))
    margin = F.col("t") * (F.col("std") / F.sqrt("n"))
    return m.select(
        "SalesGroup",
        F.col("n").alias("Vendors"),
        F.col("mean").alias("MeanMargin"),
        (F.col("mean") - margin).alias("Lower"),
        (F.col("mean") + margin).alias("Upper"),
    )


def welch_test(groups: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Welch's t-test between the top and the low group, one row; NULL without any spread."""

    @F.pandas_udf("double")
    def two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([t_two_sided(a, b) for a, b in zip(t, df, strict=True)])

    m = group_moments(groups)

    def of(column: str, group: str) -> Column:
        return F.max(F.when(F.col("SalesGroup") == group, F.col(column)))

    one = m.agg(
        *[of(c, g).alias(f"{c}_{g}") for c in ("n", "mean", "var") for g in ("Top", "Low")]
    )
    a, b = F.try_divide("var_Top", "n_Top"), F.try_divide("var_Low", "n_Low")
    t = F.try_divide(F.col("mean_Top") - F.col("mean_Low"), F.sqrt(a + b))
    rest = F.try_divide(a * a, F.col("n_Top") - 1) + F.try_divide(b * b, F.col("n_Low") - 1)
    df = F.try_divide(F.pow(a + b, 2), rest)
    tested = one.select(t.alias("TStatistic"), df.alias("DegreesOfFreedom"))
    p = F.when(F.col("TStatistic").isNotNull(), F.nanvl(two_sided("TStatistic", "DegreesOfFreedom"), F.lit(None)))
    return tested.withColumn("PValue", p).withColumn("RejectEqualMeans", F.col("PValue") < alpha)
