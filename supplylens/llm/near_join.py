"""N-gram Jaccard join by rare-first prefix filtering, grouped into components.

Two texts link if their sets of word n-grams have a Jaccard similarity of at least ``num / den``.

1. Order. Every n-gram is counted over the whole corpus into 2^20 hashed counters, 8 MB whatever
   the corpus; n-grams are ordered by their counter, rarest first, ties by fingerprint. Any common
   order gives the same links; a good one puts what sets a text apart to the front.
2. Prefix. Linked texts of n and m n-grams share one among the first n - ceil(t n) + 1 of each, so
   only these are emitted, each with the text's size and the n-gram's place. A task emits equal
   sets once. N-grams that turn out to be on their own go at once.
3. Centres. For each n-gram the text that has it earliest is the centre: it has the fewest rarer
   n-grams, so it is closest to what the others have in common. All others are joined to it, under
   the length and the positional filter.
4. Rest. With the components that these links give, only texts of different components are still
   of interest. The texts of an n-gram meet in blocks of about ``PER_BLOCK``, every two blocks in one
   place, and are compared there under the same filters and by their sketches; only what passes
   leaves the task. A large group of near copies is linked through its centres and needs none of it;
   texts of one template that stay under the threshold are told apart here, without their texts.
5. Each candidate pair is verified once on whole texts, after the sketch and the suffix filter.

A sketch adds up the n-grams' fingerprints in ``CELLS`` bytes. Two sets that differ in d n-grams differ in
d cells at most, so pairs with more differing cells than the threshold allows n-grams cannot link.

N-grams are 64-bit fingerprints; sets are matched by a 128-bit digest. Hot n-grams are split by a
salt that follows their counter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.workspace import hold
from . import kept
from .components import connected_components
from .names import unused
from .shipping import ship
from .skew import join_keys
from .text import raw_texts, shingles, slices

BITS = 20
BLOCK = 4096
SALT_ROWS = 200_000  # an n-gram with a larger counter is dealt to several tasks
CELLS = 128
PER_BLOCK = 256
SHORT = 64  # rows of a list that is always compared together with others
_KEPT_SETS = 500_000  # set digests that a task remembers to leave out its own copies


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _sketch(grams: np.ndarray) -> bytes:
    cells = np.bincount((grams >> np.uint64(57)).astype(np.int64), weights=grams & np.uint64(255), minlength=CELLS)
    return cells.astype(np.int64).astype(np.uint8).tobytes()


def _measured(rows: DataFrame, size: int) -> DataFrame:
    """(id, n, key, sketch) of every row, and the tasks' counters as (block, counts) rows."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("near_join")
        total = np.zeros(1 << BITS, dtype=np.int64)
        for batch in (part for whole in table for part in slices(whole, "text")):
            n, keys, sketches = [], [], []
            for raw in raw_texts(batch.column("text")):
                grams = shingles(raw, size)
                np.add.at(total, (grams >> np.uint64(64 - BITS)).astype(np.int64), 1)
                n.append(len(grams))
                keys.append(_digest(grams) if len(grams) else None)
                sketches.append(_sketch(grams))
            nothing = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
                    nothing.cast(pa.int32()), nothing.cast(pa.binary()),
                ],
                names=["id", "n", "key", "sketch", "block", "counts"],
            )
        blocks = [k for k in range(0, 1 << BITS, BLOCK) if total[k : k + BLOCK].any()]
        empty = pa.nulls(len(blocks))
        yield pa.RecordBatch.from_arrays(
            [
                empty.cast(pa.int64()), empty.cast(pa.int64()), empty.cast(pa.binary()), empty.cast(pa.binary()),
                pa.array([k // BLOCK for k in blocks], pa.int32()),
                pa.array([total[k : k + BLOCK].astype("<i8").tobytes() for k in blocks], pa.binary()),
            ],
            names=["id", "n", "key", "sketch", "block", "counts"],
        )

    return rows.mapInArrow(run, "id long, n long, key binary, sketch binary, block int, counts binary")


def _counters(blocks: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters: 2^BITS numbers."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in table:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(counts, dtype="<i8")
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            names=["block", "counts"],
        )

    total = np.zeros(1 << BITS, dtype=np.int64)
    for row in blocks.repartition("block").mapInArrow(run, "block int, counts binary").toLocalIterator():
        total[row["block"] * BLOCK :][:BLOCK] = np.frombuffer(row["counts"], dtype="<i8")
    return total


def _prefixes(rows: DataFrame, size: int, num: int, den: int, counters: np.ndarray) -> DataFrame:
    """(gram, salt, salted, id, n, at) for the prefix of every set that the task meets for the first time."""
    spark = rows.sparkSession
    grade = np.minimum(np.log2(counters + 1.0) * 1024, 65535).astype(np.uint16)
    salts = np.maximum(1, -(-counters // SALT_ROWS)).astype(np.int64)
    shared = spark.sparkContext.broadcast((grade, salts, counters == 1))
    shift = np.uint64(64 - BITS)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("near_join")
        grade, salts, single = shared.value
        seen: set[bytes] = set()
        for batch in (part for whole in table for part in slices(whole, "text")):
            out: list[tuple] = []
            for id_, raw in zip(batch.column("id").to_pylist(), raw_texts(batch.column("text")), strict=True):
                grams = shingles(raw, size)
                n = len(grams)
                key = _digest(grams)
                if not n or key in seen:
                    continue
                if len(seen) >= _KEPT_SETS:
                    seen.clear()
                seen.add(key)
                buckets = (grams >> shift).astype(np.int64)
                first = np.argsort(grade[buckets], kind="stable")[: n - (-(-num * n // den)) + 1]
                at = np.flatnonzero(~single[buckets[first]])
                first = first[at]
                dealt = salts[buckets[first]]
                out.append((grams[first].view(np.int64), id_ % dealt, dealt > 1, np.full(len(at), id_), np.full(len(at), n), at))
                if len(out) >= 2000:
                    yield _stacked(out)
                    out = []
            if out:
                yield _stacked(out)

    return rows.mapInArrow(run, "gram long, salt long, salted boolean, id long, n int, at int")


def _stacked(parts: list[tuple]) -> pa.RecordBatch:
    gram, salt, salted, id_, n, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(gram), pa.array(salt, pa.int64()), pa.array(salted), pa.array(id_, pa.int64()),
            pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32)),
        ],
        names=["gram", "salt", "salted", "id", "n", "at"],
    )


def _shared_only(prefixes: DataFrame) -> DataFrame:
    """Without n-grams that one text alone has; those dealt by salt may meet later and all stay."""
    together = W.partitionBy("gram", "salt")
    return prefixes.withColumn("_n", F.count(F.lit(1)).over(together)).where("_n > 1 or salted").drop("_n", "salt", "salted")


def _may_link(num: int, den: int) -> Column:
    """Length and positional filter for rows x and y that share an n-gram at places xat and yat.

    The n-gram is taken as the first that both have, which it is for at least one row of every
    linked pair; then at most what follows it in either set can be common.
    """
    xn, yn = F.col("xn").cast("long"), F.col("yn").cast("long")
    most = F.least(xn - F.col("xat"), yn - F.col("yat"))
    return (den * F.least(xn, yn) >= num * F.greatest(xn, yn)) & ((num + den) * most >= num * (xn + yn))


def _as(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select("gram", *[F.col(c).alias(side + c) for c in columns])


def _suffix_allows(x: np.ndarray, y: np.ndarray, need: int, depth: int = 3) -> bool:
    """Suffix filter: halve both sets at a pivot of y and add up what the parts can share at most."""
    parts = [(x, y)]
    for _ in range(depth):
        finer = []
        for a, b in parts:
            if len(b) < 2:
                finer.append((a, b))
                continue
            pivot = b[len(b) // 2]
            i, j = np.searchsorted(a, pivot), len(b) // 2
            finer += [(a[:i], b[:j]), (a[i:], b[j:])]
        parts = finer
        if sum(min(len(a), len(b)) for a, b in parts) < need:
            return False
    return True


def _verified(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (x, y) that link, compared on whole texts, once each."""
    joined = (
        pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("xtext")), "x")
        .join(texts.select(F.col("id").alias("y"), F.col("text").alias("ytext")), "y")
        .select("x", "y", "xtext", "ytext")
    )

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("near_join")
        last, grams = None, np.empty(0, dtype=np.uint64)
        for whole in table:
            for batch in slices(whole, "ytext"):
                keep = []
                for xraw, yraw in zip(raw_texts(batch.column("xtext")), raw_texts(batch.column("ytext")), strict=True):
                    x = shingles(xraw, size)
                    if yraw != last:
                        last, grams = yraw, shingles(yraw, size)
                    need = -(-num * (len(x) + len(grams)) // (num + den))
                    linked = min(len(x), len(grams)) >= need and _suffix_allows(x, grams, need)
                    keep.append(linked and len(np.intersect1d(x, grams, assume_unique=True)) >= need)
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("x").filter(mask), batch.column("y").filter(mask)], names=["x", "y"]
                )

    return joined.mapInArrow(run, "x long, y long").distinct()


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sketches as rows of ``CELLS`` bytes, and which rows have one."""
    known = pc.is_valid(column).to_numpy(zero_copy_only=False)
    raw = b"".join(x if x is not None else bytes(CELLS) for x in column.to_pylist())
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, CELLS), known


def _most_apart(xn: np.ndarray, yn: np.ndarray, num: int, den: int) -> np.ndarray:
    """N-grams that linked sets of these sizes can differ in."""
    return xn + yn - 2 * -(-num * (xn + yn) // (num + den))


def _alike(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (x, y) whose sketches do not rule a link out."""
    x = sketches.select(F.col("id").alias("x"), F.col("n").alias("xn"), F.col("sketch").alias("xs"))
    y = sketches.select(F.col("id").alias("y"), F.col("n").alias("yn"), F.col("sketch").alias("ys"))

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            (a, a_known), (b, b_known) = _cells(batch.column("xs")), _cells(batch.column("ys"))
            xn, yn = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("xn", "yn"))
            keep = ((a != b).sum(axis=1) <= _most_apart(xn, yn, num, den)) | ~(a_known & b_known)
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    return pairs.join(x, "x").join(y, "y").select("x", "y", "xn", "yn", "xs", "ys").mapInArrow(run, "x long, y long")


def _between(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(x, y): pairs of different groups that share an n-gram and pass the filters.

    ``rows``: (gram, id, n, at, group, sketch, blocks). Every two blocks of an n-gram are one bounded list;
    a row is in as many lists as its n-gram has blocks.
    """
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    lists = dealt.groupBy("gram", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(
        F.collect_list(F.struct("id", "n", "at", "group", "own", "sketch")).alias("members")
    ).where(F.size("members") > 1)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            lists = batch.column("members")
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten()
            ids, n, at, group, own = (
                flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "n", "at", "group", "own")
            )
            cells, known = _cells(flat.field("sketch"))
            ends = np.cumsum(sizes)
            crossing = batch.column("lo").to_numpy() != batch.column("hi").to_numpy()
            found = []

            def compare(i: np.ndarray, j: np.ndarray, cross: np.ndarray | bool) -> None:
                most = np.minimum(n[i] - at[i], n[j] - at[j])
                may = (group[i] != group[j]) & (ids[i] != ids[j]) & (~np.asarray(cross) | (own[i] != own[j]))
                may &= (den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])) & ((num + den) * most >= num * (n[i] + n[j]))
                a, b = i[may], j[may]
                apart = (cells[a] != cells[b]).sum(axis=1)
                near = (apart <= _most_apart(n[a], n[b], num, den)) | ~(known[a] & known[b])
                if near.any():
                    found.append((ids[a[near]], ids[b[near]]))

            # lists that one group has most of: its few others meet all, which spares it its own pairs
            together = np.ones(len(sizes), dtype=bool)
            for k, (lo, hi) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
                if hi - lo <= SHORT:
                    continue
                places = np.unique(group[lo:hi], return_inverse=True)[1]
                members = np.bincount(places)
                if 2 * members.max() < hi - lo:
                    continue
                together[k] = False
                main, every = members.argmax(), np.arange(lo, hi)
                for i in every[places != main].tolist():
                    j = every[(places == main) | (every > i)]
                    compare(np.full(len(j), i), j, crossing[k])
            # all others at once: each row with the next in its list, the one after it and so on
            last, across = np.repeat(ends, sizes), np.repeat(crossing, sizes)
            i, step = np.flatnonzero(np.repeat(together, sizes)), 0
            while len(i):
                step += 1
                i = i[i + step < last[i]]
                compare(i, i + step, across[i])
            if found:
                x, y = (np.concatenate(part) for part in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"])

    return lists.select("lo", "hi", "members").mapInArrow(run, "x long, y long").distinct()


def _pairs(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.least("xid", "yid").alias("x"), F.greatest("xid", "yid").alias("y")).where("x < y").distinct()


def near_components(
    docs: DataFrame, size: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links).

    Words are as in ``text.word_hashes``; a text with fewer words than ``size`` has them all as its
    one n-gram. Null and empty texts, and texts without words, have no n-grams and link to nothing.
    Equal sets link. Rows that repeat an id each give a row; the id is one node, so its texts are in
    one component if they differ. A null id has no component and links nothing. Ids must be whole
    numbers. Columns of other names are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    measured = hold(_measured(texts, size), "measured")
    sets = measured.where("block is null").select("id", "n", "key", "sketch")
    counters = _counters(measured.where("block is not null").select("block", "counts"))

    named = sets.where("id is not null and key is not null").select("id", "key")
    reps = hold(named.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "representatives")
    members = hold(join_keys(named, reps.select("key", "rep"), "key", reps).select("id", "rep").distinct(), "members")
    # an id with several texts has no sketch
    one = F.min("key") == F.max("key")
    sketches = hold(
        sets.where("id is not null and key is not null").groupBy("id")
        .agg(F.max("n").alias("n"), F.when(one, F.max("sketch")).alias("sketch")),
        "sketches",
    )
    prefixes = _prefixes(texts.where("id is not null"), size, num, den, counters)
    # copies of a set in different tasks become one representative here
    shared = hold(
        _shared_only(prefixes).join(members, "id").select("gram", F.col("rep").alias("id"), "n", "at").distinct(), "prefixes"
    )
    centres = shared.groupBy("gram").agg(F.min(F.struct("at", "id", "n")).alias("c"), F.count(F.lit(1)).alias("_n"))
    centres = centres.where("_n > 1").select("gram", F.col("c.id").alias("yid"), F.col("c.n").alias("yn"), F.col("c.at").alias("yat"))
    near = _as(shared, "x", "id", "n", "at").join(centres, "gram").where(_may_link(num, den))
    first = hold(_pairs(near), "centre-pairs")
    known = texts.where("id is not null")
    alike = hold(_alike(first, sketches, num, den), "alike-centre-pairs")
    links = hold(_verified(alike, known, size, num, den), "centre-links")

    same = members.where("id <> rep").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    groups = hold(connected_components(links.union(same), "x", "y"), "groups")
    placed = shared.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "gram", "id", "n", "at", F.coalesce("component", "id").alias("group")
    )
    placed = hold(placed, "placed")
    mixed = placed.groupBy("gram").agg(
        F.min("group").alias("_lo"), F.max("group").alias("_hi"), F.ceil(F.count(F.lit(1)) / PER_BLOCK).alias("blocks")
    ).where("_lo < _hi").select("gram", "blocks")
    apart = placed.join(mixed, "gram").join(sketches.select("id", "sketch"), "id")
    rest = _between(apart, num, den)
    more = hold(rest.join(first, ["x", "y"], "left_anti"), "other-pairs")
    late = hold(_verified(more, known, size, num, den), "other-links")
    final = connected_components(groups.select(F.col("node").alias("x"), F.col("component").alias("y")).union(late), "x", "y")

    return (
        sets.join(final.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("key").isNull(), F.col("id")).otherwise(F.coalesce("component", "id")).alias("component_id"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The row with the smallest id of each component, all columns; a null id links nothing and stays."""
    found = near_components(docs, size, num, den, id_col, text_col)
    [key] = unused(docs.columns, "_gone")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(key)).distinct()
    return docs.join(gone, docs[id_col] == gone[key], "left_anti")
