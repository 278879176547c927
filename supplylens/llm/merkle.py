"""Merkle manifest of a dataset: lag and lead columns per level supply siblings and hash parents.

A row is a leaf; the leaves of a group ascend by id, and every three consecutive nodes of a level
become their hash until one is left, the group's subroot. Subroots, in the order of their groups,
become the root in the same way.

1. Places. The leaves are sorted by ranges of (group, id), written, and counted by (range, group), so
   a leaf's place in its group is the count of earlier ranges and its own number in its range. No
   group is in one task.
2. Chunks. 3^CHUNK_LEVELS consecutive nodes are one window partition. A node of level k stands in the
   row of its first leaf, so its siblings are 3^k or 2 * 3^k rows away: one lag and one lead column for
   each offset, masked by the node's slot in its run and the run's length. First-child rows hash the
   parent. Every level of a chunk uses the same partitioning and order: one shuffle for five levels.
3. The tops of the chunks are the leaves of the next, 243 times smaller, table, until each group has one.
4. Down again: a node's path to the top is its siblings and its parent's path, a fixed lag away.

A chunk has few levels, and its siblings are written before the way down, so that a stage holds few
windows: Spark keeps the code of about a hundred generated classes, and compiles them anew for every
task of a stage that has more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.workspace import hold

FAN = 3
CHUNK_LEVELS = 5  # 243 rows to a window partition
_NO_PATH = "cast(array() as array<struct<left: string, right: string>>)"


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[encoded(f) for f in fields]))


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, ...) with ``at``, the place in its group from 0, and ``n``, the group's size.

    ``key`` is the order in a group. Equal keys take places in the order in which they were written,
    so a key that a third of all rows share is spread over ranges too.
    """
    rows = hold(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    order = ["group", "key", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = hold(ranged.withColumn("number", F.monotonically_increasing_id()), "in-order")
    parts = numbered.groupBy("group", F.shiftright("number", 33).alias("range")).agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("many")
    )  # a row for each group and each range border
    before = W.partitionBy("group").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        "group", "range", (F.coalesce(F.sum("many").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("many").over(W.partitionBy("group")).alias("n"),
    )
    joined = numbered.withColumn("range", F.shiftright("number", 33)).join(offsets, ["group", "range"])
    return joined.withColumn("at", F.col("number") + F.col("shift")).drop("number", "range", "shift", "tie", "key")


def _width(level: int) -> Column:
    """Nodes of the row's group on this level of the chunk; 1 from the top on."""
    return F.expr(f"(n + {FAN**level - 1}) div {FAN**level}")


def _climbed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (group, at, n, node, ...) with each level's siblings and nodes, in the rows of their first leaves.

    Columns left{k} and right{k}: the siblings of the level-k node, as text, null where the level has one
    node only; top: the chunk's top node; chunk: the place of the chunk among the group's chunks.
    """
    out = nodes.withColumn("chunk", F.expr(f"at div {FAN**CHUNK_LEVELS}")).withColumn("node0", F.col("node"))
    chunk = W.partitionBy("group", "chunk").orderBy("at")
    for k in range(CHUNK_LEVELS):
        step, here = FAN**k, F.col(f"node{k}")
        near = {f"_{way.__name__}{i}": way(here, i * step).over(chunk) for way in (F.lag, F.lead) for i in (1, 2)}
        place = F.expr(f"at div {step}")
        out = out.withColumns(near).withColumns({
            "_slot": F.when(F.expr(f"at % {step} = 0") & (_width(k) > 1), place % FAN),
            "_run": F.least(F.lit(FAN).cast("long"), _width(k) - (place - place % FAN)),
        })
        slot, run = F.col("_slot"), F.col("_run")

        def after(i: int, slot: Column = slot, run: Column = run) -> Column:
            return F.when(slot + i < run, F.col(f"_lead{i}")).otherwise("")

        left = F.when(slot == 0, "").when(slot == 1, F.col("_lag1")).when(slot == 2, F.concat("_lag2", "_lag1"))
        right = F.when(slot == 0, F.concat(after(1), after(2))).when(slot == 1, after(1)).when(slot == 2, "")
        parent = F.when(slot == 0, digest(F.concat(here, after(1), after(2)))).when(_width(k) == 1, here)
        out = out.withColumns({f"left{k}": left, f"right{k}": right, f"node{k + 1}": parent})
        out = out.drop(*near, "_slot", "_run", f"node{k}")
    return out.withColumnRenamed(f"node{CHUNK_LEVELS}", "top")


def _tops(climbed: DataFrame) -> DataFrame:
    """(group, at, n, node): the chunks' top nodes, as nodes of a smaller table."""
    top = climbed.where(f"at % {FAN**CHUNK_LEVELS} = 0")
    return top.select("group", F.col("chunk").alias("at"), _width(CHUNK_LEVELS).alias("n"), F.col("top").alias("node"))


def _descended(climbed: DataFrame, above: DataFrame) -> DataFrame:
    """Each row's path: the siblings of every level from its own to the root, as an array of (left, right).

    ``above`` has (group, chunk, path, ...) of the chunks' tops; its further columns come along.
    """
    out = climbed.join(above, ["group", "chunk"])
    chunk = W.partitionBy("group", "chunk").orderBy("at")
    for k in reversed(range(CHUNK_LEVELS)):
        step = FAN**k
        lags = {f"_path{i}": F.lag("path", i * step).over(chunk) for i in (1, 2)}
        slot = F.expr(f"(at div {step}) % {FAN}")
        parents = F.when(slot == 0, F.col("path")).when(slot == 1, F.col("_path1")).otherwise(F.col("_path2"))
        own = F.array(F.struct(F.col(f"left{k}").alias("left"), F.col(f"right{k}").alias("right")))
        path = F.when(F.col(f"left{k}").isNull(), parents).otherwise(F.concat(own, parents))
        out = out.withColumns(lags).withColumn("path", F.when(F.expr(f"at % {step} = 0"), path)).drop(*lags, f"left{k}", f"right{k}")
    return out.drop("top")


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` climbed, its chunks' tops climbed and so on, until every group has one node; and these."""
    climbed: list[DataFrame] = []
    while True:
        widest = nodes.agg(F.max("n")).first()[0]
        if widest is None or widest == 1:
            return climbed, nodes
        climbed.append(hold(_climbed(nodes), "climbed"))
        nodes = hold(_tops(climbed[-1]), "tops")


def _paths(climbed: list[DataFrame], last: DataFrame, root: DataFrame) -> DataFrame:
    """The lowest level's rows with their path; ``root`` has (group, path, ...) of the groups' last nodes."""
    if not climbed:
        return last.join(root, "group")
    above = last.select("group", "at").join(root, "group")
    for k, level in reversed(list(enumerate(climbed))):
        above = _descended(level, above.withColumnRenamed("at", "chunk"))
        if k:
            above = hold(above.drop("n", "node", "chunk"), "paths")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: id, group, leaf, subroot, root, path, changed_leaf, folded_root, verified.

    A leaf is the hash of the row's ``fields``. ``path`` holds the siblings from the leaf to the root; a
    level with a single node has none. ``changed`` replaces fields by expressions: changed_leaf is the
    leaf of the row so changed, folded_root what it gives with the original siblings, and verified
    whether that is still the root. Leaves of a group ascend by id, null ids first; rows that repeat an
    id follow each other by their leaf, and equal rows are leaves of their own. Null is a group
    of its own, the first; groups are in bytewise order. A lone leaf is its group's subroot, a lone
    subroot the root. Columns of other names are ignored; an empty table gives no rows.
    """
    changed = changed or {}
    own = leaf([F.col(f) for f in fields])
    other = leaf([changed.get(f, F.col(f)) for f in fields])
    differs = F.lit(False)
    for f, to in changed.items():
        differs = differs | ~to.eqNullSafe(F.col(f))
    leaves = docs.select(
        # no null in a join: null is '', any other group begins with a letter, and the order stays
        F.coalesce(F.concat(F.lit("g"), F.col(group_col).cast("string")), F.lit("")).alias("group"),
        F.col(id_col).alias("id"),
        own.alias("node"),
        F.when(differs, other).alias("other"),
    ).withColumn("key", F.struct("id", "node"))
    nodes = hold(_placed(leaves), "placed")
    climbed, last = _levels(nodes)

    subroots = last.select(F.lit("").alias("group"), F.col("group").alias("key"), "node")
    groups = hold(_placed(subroots.withColumn("name", F.col("key"))), "subroots")
    tree, top = _levels(groups)
    root = top.select("group", F.col("node").alias("root"), F.expr(_NO_PATH).alias("path"))
    to_root = hold(_paths(tree, top, root).select(F.col("name").alias("group"), "root", "path"), "to-root")
    tops = last.select("group", F.col("node").alias("subroot")).join(to_root, "group")
    out = _paths(climbed, last, tops)
    changed_leaf = F.coalesce("other", "node")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("group") != "", F.substring("group", 2, 2**31 - 1)).alias(group_col),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "path",
        changed_leaf.alias("changed_leaf"),
        folded(changed_leaf, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """The hash of a path's siblings, level by level and left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))
