"""Small DataFrame helpers: scalars, null-safe merges, labelled aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame to every row as a scalar subquery."""
    packed = one_row.select(F.struct("*").alias("row")).scalar()
    names = [f"_scalars.`{n}` AS `{n}`" for n in one_row.columns]
    return df.withColumn("_scalars", packed).selectExpr("*", *names).drop("_scalars")


def one_row_per(df: DataFrame, keys: Sequence[str], named: Sequence[str] | None = None) -> DataFrame:
    """``df``, whose rows fail when they are read if a key occurs twice; ``named``: what the error shows.

    The check is part of the plan: it needs the rows together by key, which they are already where
    ``df`` was grouped by it or is about to be joined on it.
    """
    shown = named or keys
    label = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in shown])
    problem = F.concat(F.lit(f"more than one row for {', '.join(shown)}: "), label)
    times = F.count(F.lit(1)).over(W.partitionBy(*keys))
    return df.withColumn("_times", times).where(
        F.when(F.col("_times") > 1, F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))
    ).drop("_times")


def merge_left(
    left: DataFrame, right: DataFrame, keys: Sequence[str], one_to_one: bool = False
) -> DataFrame:
    """Left join in which NULL keys meet NULL keys; the right side's key columns are dropped.

    ``one_to_one`` raises if a key occurs twice on either side.
    """
    return merge(left, [right], keys, "left", one_to_one)


def merge_inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys meet NULL keys."""
    return merge(left, [right], keys, "inner")


def merge(
    left: DataFrame, rights: Sequence[DataFrame], keys: Sequence[str], how: str, one_to_one: bool = False
) -> DataFrame:
    """``left`` joined with each of ``rights`` in turn; NULL keys meet NULL keys.

    The keys are packed into one struct, which is never NULL and equal where all its parts are, so
    every side is shuffled by it once: the check for repeated keys and all joins use that partitioning.
    """
    def packed(df: DataFrame) -> DataFrame:
        df = df.withColumn("_key", F.struct(*keys))
        return one_row_per(df, ["_key"], keys) if one_to_one else df

    out = packed(left)
    for right in rights:
        out = out.join(packed(right).drop(*keys), "_key", how)
    return out.drop("_key")


def aggregate_with_labels(
    df: DataFrame,
    keys: Sequence[str],
    labels: Mapping[str, Column],
    first: Mapping[str, Column],
    last: Mapping[str, Column],
) -> DataFrame:
    """Group by ``keys``, keeping the greatest value of each text label.

    MAX over text cannot use a hash aggregate and would sort the raw rows. The labels
    are few per key, so they are grouped on first (``first`` aggregates, hash based),
    and the greatest label is taken over the small result (``last`` aggregates over the
    names produced by ``first``).
    """
    narrow = df.withColumns(dict(labels)).groupBy(*keys, *labels).agg(
        *[c.alias(n) for n, c in first.items()]
    )
    return narrow.groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in labels], *[c.alias(n) for n, c in last.items()]
    )
