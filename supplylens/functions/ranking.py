"""Global order without a single-task window.

A window with no partition key pulls a whole table into one task. Here the rows are dealt into
ranges of the key by Spark's range partitioning, which takes its cut points from a bounded sample,
and written with their range number. So there are as many ranges as shuffle partitions; per-range
totals are a table of that many rows, and only the order inside one range is left to a window. Rows
with equal values of one column may be dealt to several ranges if further columns tell them apart;
where their tie matters, the ranges at whose borders it is cut are put together again by their
totals. All results are exact; the sample only balances.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .workspace import hold


def with_range(df: DataFrame, order: Sequence[Column | str], label: str = "ranges") -> DataFrame:
    """Write ``df`` in ranges of ``order`` and add ``_range``, ascending with it.

    Rows that are equal in all of ``order`` share a range.
    """
    return hold(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label)


def _starts(ranged: DataFrame, within: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Total of each measure before every range; one row per range and group."""
    totals = ranged.groupBy(*within, "_range").agg(*[c.alias(n) for n, c in measures.items()])
    group = [F.col(c) for c in within] or [F.lit(0)]
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    return totals.select(
        *within,
        "_range",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in measures],
        *[F.sum(n).over(whole).alias(f"_all_{n}") for n in measures],
        *[F.col(n).alias(f"_in_{n}") for n in measures],
    )


def running_sum(df: DataFrame, order: Sequence[Column], addend: Column, name: str) -> DataFrame:
    """Row-wise running sum over the whole frame in the given (unique) order."""
    ranged = with_range(df.withColumn("_addend", addend), order)
    starts = _starts(ranged, [], {"sum": F.sum("_addend")}).select("_range", "_before_sum")
    w = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        # a row for each shuffle partition
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_before_sum") + F.sum("_addend").over(w))
        .drop("_range", "_addend", "_before_sum")
    )


def earlier_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], addend: Column, name: str
) -> DataFrame:
    """Sum of ``addend`` over the rows before each one in its group, by the (unique) order; 0 for the first.

    A group may fill many ranges: what earlier ranges hold of it is carried over by a table of the groups
    that a range begins or ends with.
    """
    ranged = with_range(df.withColumn("_addend", addend), [*group, *order]).withColumn("_group", F.struct(*group))
    edges = ranged.groupBy("_range").agg(F.min("_group").alias("_lo"), F.max("_group").alias("_hi"))
    cut = ranged.join(F.broadcast(edges), "_range").where("_group = _lo or _group = _hi")  # two groups a range
    parts = cut.groupBy("_group", "_range").agg(F.sum("_addend").alias("_part"))
    before = W.partitionBy("_group").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select("_group", "_range", F.sum("_part").over(before).alias("_carried")).where("_carried is not null")
    inside = W.partitionBy("_group", "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0)
    return (
        ranged.withColumn(name, F.sum("_addend").over(inside))
        .join(F.broadcast(carried), ["_group", "_range"], "left")
        .withColumn(name, F.coalesce(name, zero) + F.coalesce("_carried", zero))
        .drop("_addend", "_group", "_range", "_carried")
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Position 1..n of every row in the given (unique) order."""
    return running_sum(df, order, F.lit(1).cast("long"), name)


def thirds(df: DataFrame, order: Sequence[Column], labels: Sequence[str], name: str) -> DataFrame:
    """Cut the ordered rows into three classes at the quantile edges 1/3 and 2/3.

    Of n rows the first class takes (n+1) div 3, the second n div 3, the third the rest.
    Only ranges that hold a cut are sorted.
    """
    low, mid, high = labels
    ranged = with_range(df, order)
    starts = _starts(ranged, [], {"n": F.count(F.lit(1))})
    first = F.floor((F.col("_all_n") + 1) / 3)
    second = first + F.floor(F.col("_all_n") / 3)

    def label(position: Column) -> Column:
        return F.when(position <= first, low).when(position <= second, mid).otherwise(high)

    edges = starts.select(
        "_range",
        "_before_n",
        "_all_n",
        label(F.col("_before_n") + 1).alias("_lowest"),
        label(F.col("_before_n") + F.col("_in_n")).alias("_highest"),
    )
    joined = ranged.join(F.broadcast(edges), "_range")
    whole = joined.where(F.col("_lowest") == F.col("_highest")).withColumn(name, F.col("_lowest"))
    w = W.partitionBy("_range").orderBy(*order)
    split = joined.where(F.col("_lowest") != F.col("_highest")).withColumn(
        name, label(F.col("_before_n") + F.row_number().over(w))
    )
    columns = [F.col(f"`{c}`") for c in df.columns] + [F.col(name)]
    return whole.select(*columns).unionByName(split.select(*columns))


def _positions(ranged: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows (group, value, ..., _range) with ``below``, ``ties`` and ``total`` of their value.

    The rows must have been dealt by (group, value, ...). Inside a range a window counts; a value that
    ends one range and begins the next takes its first and last place from the ranges' totals.
    """
    counted = ranged.groupBy(*group, "_range", value).agg(F.count(F.lit(1)).alias("c"))
    per_range = counted.groupBy(*group, "_range").agg(
        F.sum("c").alias("n"), F.min(F.struct(value, "c")).alias("f"), F.max(F.struct(value, "c")).alias("l")
    )
    keys = [F.col(c) for c in group] or [F.lit(0)]
    in_order = W.partitionBy(*keys).orderBy("_range")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = per_range.select(
        *group, "_range", "n", before.alias("_before"), F.sum("n").over(W.partitionBy(*keys)).alias("total"),
        F.col(f"f.{value}").alias("_first"), F.col("f.c").alias("_n_first"),
        F.col(f"l.{value}").alias("_last"), F.col("l.c").alias("_n_last"),
        F.lag(f"l.{value}").over(in_order).alias("_previous"), F.lead(f"f.{value}").over(in_order).alias("_next"),
    )
    began = F.min(F.col("_before") + F.col("n") - F.col("_n_last")).over(W.partitionBy(*keys, "_last"))
    ended = F.max(F.col("_before") + F.col("_n_first")).over(W.partitionBy(*keys, "_first"))
    spans = placed.withColumns({"_began": began, "_ended": ended}).withColumns({
        # of a value that this range continues, and of one that the next does
        "_began_first": F.when(F.col("_previous") == F.col("_first"), F.lag("_began").over(in_order)),
        "_ended_last": F.when(F.col("_next") == F.col("_last"), F.lead("_ended").over(in_order)),
    })
    borders = spans.select(*group, "_range", "total", "_before", "_first", "_last", "_began_first", "_ended_last")
    inside = W.partitionBy(*group, "_range").orderBy(value)
    up_to = F.count(F.lit(1)).over(inside.rangeBetween(W.unboundedPreceding, W.currentRow))
    rows = ranged.withColumns({"_rank": F.rank().over(inside) - 1, "_up_to": up_to}).join(
        # a row for each shuffle partition and group that it has rows of
        F.broadcast(borders), [*group, "_range"]
    )
    at_first = (F.col(value) == F.col("_first")) & F.col("_began_first").isNotNull()
    at_last = (F.col(value) == F.col("_last")) & F.col("_ended_last").isNotNull()
    below = F.when(at_first, F.col("_began_first")).otherwise(F.col("_before") + F.col("_rank"))
    end = F.when(at_last, F.col("_ended_last")).otherwise(F.col("_before") + F.col("_up_to"))
    return rows.withColumns({"below": below, "_end": end}).withColumn("ties", F.col("_end") - F.col("below")).drop(
        "_rank", "_up_to", "_end", "_before", "_first", "_last", "_began_first", "_ended_last"
    )


def ranked_rows(df: DataFrame, value: Column, then: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with the order of ``value``, ascending, ties by ``then``: one write for all of it.

    Adds ``below`` (rows of smaller value), ``ties``, ``total``, and for each of ``sums`` the running
    sum under its name and the sum of all rows as ``{name}_total``.
    """
    ranged = with_range(df.withColumn("_value", value).withColumns({f"_a_{n}": c for n, c in sums.items()}), ["_value", *then])
    out = _positions(ranged, [], "_value")
    starts = _starts(ranged, [], {n: F.sum(f"_a_{n}") for n in sums}).select(
        "_range", *[f"_before_{n}" for n in sums], *[F.col(f"_all_{n}").alias(f"{n}_total") for n in sums]
    )
    w = W.partitionBy("_range").orderBy("_value", *then).rowsBetween(W.unboundedPreceding, 0)
    running = {n: F.col(f"_before_{n}") + F.sum(f"_a_{n}").over(w) for n in sums}
    done = out.join(F.broadcast(starts), "_range").withColumns(running)
    return done.drop("_range", "_value", *[f"_a_{n}" for n in sums], *[f"_before_{n}" for n in sums])


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per non-NULL cell: (keys, metric, value)."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(*keys, F.explode(cells).alias("cell"))
        .select(*keys, "cell.metric", "cell.value")
        .where(F.col("value").isNotNull())
    )


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value occurs: (metric, value, ties). Hot values combine map-side."""
    return long_form(df, columns).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("ties"))


def value_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each distinct value of each column: rows below it, rows equal to it, all rows.

    Quantiles and competition ranks follow from these.
    """
    ranged = with_range(frequencies(df, columns), [F.col("metric"), F.col("value")])
    starts = _starts(ranged, ["metric"], {"n": F.sum("ties")})
    w = (
        W.partitionBy("metric", "_range")
        .orderBy("value")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return ranged.join(F.broadcast(starts), ["metric", "_range"]).select(
        "metric",
        "value",
        "ties",
        (F.col("_before_n") + F.coalesce(F.sum("ties").over(w), F.lit(0))).alias("below"),
        F.col("_all_n").alias("total"),
    )


def cell_ranks(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each non-NULL cell: (keys, metric, value) and its ``below``, ``ties`` and ``total``.

    Every cell carries its own rank, so no value, however frequent, is looked up in one task.
    """
    cells = long_form(df, columns, keys)
    ranged = with_range(cells, ["metric", "value", *keys], "cells")
    return _positions(ranged, ["metric"], "value").drop("_range")


def ranks_in(ranged: DataFrame, column: str) -> DataFrame:
    """(metric, value, below, ties, total) of a column's non-NULL values; the rows were dealt by it first."""
    values = ranged.select("_range", F.lit(column).alias("metric"), F.col(f"`{column}`").cast("double").alias("value"))
    return _positions(values.where(F.col("value").isNotNull()), ["metric"], "value").drop("_range")


def quantile(p: float, only: Column | None = None) -> Column:
    """Aggregate over ``value_ranks`` or ``cell_ranks`` rows: the linearly interpolated quantile."""
    at = F.lit(p) * (F.col("total") - 1)
    mine = F.lit(True) if only is None else only
    lower = F.max(F.when(mine & (F.col("below") <= F.floor(at)), F.col("value")))
    upper = F.max(F.when(mine & (F.col("below") <= F.ceil(at)), F.col("value")))
    return lower + (upper - lower) * F.max(F.when(mine, at - F.floor(at)))


def quantiles(df: DataFrame, probes: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row of exact quantiles: {output name: (column, probability)}."""
    return quantiles_of(value_ranks(df, sorted({c for c, _ in probes.values()})), probes)


def quantiles_of(ranks: DataFrame, probes: Mapping[str, tuple[str, float]]) -> DataFrame:
    """The same from the columns' ranks."""
    return ranks.agg(
        *[quantile(p, F.col("metric") == c).alias(name) for name, (c, p) in probes.items()]
    )


def percent_ranks(
    df: DataFrame, keys: Sequence[str], directions: Mapping[str, bool]
) -> DataFrame:
    """Average-tie percent rank of each column among its non-NULL values, per key.

    ``directions`` maps a column to True when a higher value is better; otherwise the
    rank is one minus the percentage.
    """
    ranks = cell_ranks(df, keys, list(directions))
    share = (F.col("below") + (F.col("ties") + 1) / F.lit(2.0)) / F.col("total")
    return ranks.groupBy(*keys).agg(
        *[
            F.max(
                F.when(F.col("metric") == c, share if higher else F.lit(1.0) - share)
            ).alias(c)
            for c, higher in directions.items()
        ]
    )
