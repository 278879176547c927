"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one row in so many is hot; there are never more hot keys than this.
HOT_SHARE = 1000


def join_keys(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``table``, one row for each key, by ``key``; no key gathers in one task.

    ``counts`` has (key, n), the rows of each key. Keys with more than one row in ``HOT_SHARE`` are
    fewer than ``HOT_SHARE``: their part of the table is broadcast and their rows stay where they are.
    The others meet in a shuffle.
    """
    n = counts.select(F.col(key), F.col("n"))
    all_ = n.agg(F.sum("n").alias("all"))
    hot = n.where(F.col("n") * HOT_SHARE > all_.scalar()).select(key)
    few = F.broadcast(table.join(hot, key, "left_semi"))
    return rows.join(few, key).select(*rows.columns, *[c for c in table.columns if c != key]).unionByName(
        rows.join(F.broadcast(hot), key, "left_anti").join(table, key).select(
            *rows.columns, *[c for c in table.columns if c != key]
        )
    )
