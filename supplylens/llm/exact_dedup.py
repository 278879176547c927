"""Exact dedup by skew-safe combining, in DataFrame operations only.

Equal texts meet in three steps, and each step groups on the whole normalised text beside its
digest, so rows are only ever merged on equal content:

1. map-side: every task merges its own equal rows before anything is shuffled;
2. salted: what is left meets by (digest, text, salt), the salt being the task's number modulo
   ``salts``, so a text that a third of all rows share is spread over ``salts`` reducers;
3. global: at most ``salts`` partial winners per text meet by (digest, text).

Members find their winner by digest. Where two different texts share a digest (never seen with
SHA-256, easily provoked with a weaker ``digest``), those members are matched by text instead.
That branch runs only if a digest has more than one winner, which is counted first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold
from .names import unused

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _groups(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    """(_id, _digest, _copies, _keep, _size) for each id and text; _copies: how many rows these are."""
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("_digest", digest(F.col("_text")))

    local = rows.withColumn("_salt", F.spark_partition_id() % salts)
    salted = local.groupBy("_digest", "_salt", "_text").agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    )
    winners = hold(
        salted.groupBy("_digest", "_text")
        .agg(F.max("_keep").alias("_keep"), F.sum("_size").alias("_size"))
        .drop("_text"),
        "winners",
    )
    clashing = winners.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")

    columns = ["_id", "_digest", "_copies", "_keep", "_size"]
    members = rows.groupBy("_id", "_digest").agg(F.count(F.lit(1)).alias("_copies"))
    if clashing.isEmpty():
        return members.join(winners, "_digest").select(columns)
    by_digest = members.join(clashing, "_digest", "left_anti").join(winners, "_digest")
    doubtful = rows.join(clashing, "_digest", "left_semi")
    texts = doubtful.groupBy("_digest", "_text").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    by_text = (
        doubtful.groupBy("_id", "_digest", "_text").agg(F.count(F.lit(1)).alias("_copies"))
        .join(texts, ["_digest", "_text"])
    )
    return by_digest.select(columns).unionByName(by_text.select(columns))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = 16,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_digest.

    The largest id of a group stays. Null text counts as empty, and empty texts are equal to each
    other. Rows that repeat an id with the same text: each is counted in group_size and exactly one
    of them is kept. A null id is smaller than any other; a group of null ids keeps one of them.
    Other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    found = _groups(docs, id_col, text_col, digest, salts)
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_digest").alias("text_digest"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row of each group of equal texts."""
    found = hold(_groups(docs, id_col, text_col, sha256, 16), "groups")
    stays = F.col("_id").eqNullSafe(F.col("_keep"))
    gone = found.where(~stays).select("_id", "_digest")
    again = found.where(stays & (F.col("_copies") > 1)).select("_id", "_digest")
    [own, key, mine] = unused(docs.columns, "_own_digest", "_group_id", "_group_digest")
    marked = docs.withColumn(own, sha256(normalised(F.col(text_col))))
    left, again = (x.withColumnsRenamed({"_id": key, "_digest": mine}) for x in (gone.unionByName(again), again))

    def same(side: DataFrame) -> Column:
        return marked[id_col].eqNullSafe(side[key]) & (marked[own] == side[mine])

    rest = marked.join(left, same(left), "left_anti")
    if not again.isEmpty():  # rows that repeat both id and text
        one = marked.join(again, same(again), "left_semi").dropDuplicates([id_col, own])
        rest = rest.unionByName(one)
    return rest.drop(own)
