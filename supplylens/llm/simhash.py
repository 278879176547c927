"""SimHash near-dedup: fingerprints that differ in few bits, found by pigeonhole blocks.

1. Fingerprint: XXH64 of every shingle, repeats included; a bit is 1 if over half the hashes have it.
   Equal fingerprints become one row.
2. Blocks: the 64 bits are split into blocks. Fingerprints at ``most`` differing bits or fewer disagree
   in at most ``most`` blocks, so they agree in all others: each is listed under every choice of
   ``blocks - most`` blocks. How many blocks follows from the counted fingerprints, so that a choice
   has about as many values as there are fingerprints; any number of blocks finds every pair.
3. Buckets: what shares a choice of blocks is compared by Hamming distance. A bucket of more than
   ``BUCKET`` fingerprints is not compared but split again: the bits it has not used yet are cut into
   blocks in the same way, which loses no pair for the same reason. A bucket with at most 12 bits left
   can hold no more than ``BUCKET`` different fingerprints, so the splitting ends after few rounds.
4. A bucket gives the links that its fingerprints still need to be in one component, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold
from .components import connected_components
from .names import unused
from .shipping import ship
from .skew import join_keys
from .text import LOWER, raw_texts, slices

SEED = 42
BUCKET = 4096  # 2^12 different fingerprints
_CHUNK = 1 << 16
_FULL = (1 << 64) - 1


def simhash(raw: bytes, size: int) -> int:
    """The fingerprint of a text: A-Z lower-cased, words between 0x20 and 0x09-0x0D; 0 without words."""
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(size, len(words))
    starts, ends = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        part = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in part], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print) of every row; print: the fingerprint's 64 bits as a long."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in table for part in slices(whole, "text")):
            prints = np.array([simhash(raw, size) for raw in raw_texts(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], names=["id", "print"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, print long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _blocks_for(rows: int, most: int) -> int:
    """Blocks of 64 bits so that ``blocks - most`` of them have about as many values as there are rows."""
    blocks = most + 2
    while 64 * (blocks - most) // blocks < rows.bit_length() - 6:
        blocks += 1
    return blocks


def choices(used: int, most: int, blocks: int) -> list[int]:
    """The masks that the unused bits give: ``used`` and every choice of ``blocks - most`` blocks of them."""
    free = [b for b in range(64) if not used >> b & 1]
    cuts = [len(free) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    return [used | sum(chosen) for chosen in combinations(parts, blocks - most)]


def _listed(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """(mask, value, print) of rows (mask, print) under the masks that follow theirs."""
    # a table of masks: the number of choices, which only the number of rounds and blocks sets
    after = {_signed(m): F.lit([_signed(x) for x in to]) for m, to in masks.items()}
    if len(after) == 1:
        to = rows.select("print", F.explode(next(iter(after.values()))).alias("mask"))
    else:
        known = F.create_map(*[x for m, to in after.items() for x in (F.lit(m), to)])
        to = rows.select("print", F.explode(F.element_at(known, F.col("mask"))).alias("mask"))
    return to.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")


def _needed(prints: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of the same bucket; of those that close a circle only some."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    label = np.arange(len(prints))
    at, step, found = np.arange(len(prints)), 0, []
    while True:
        step += 1
        at = at[at + step < ends[at]]
        if not len(at):
            break
        open_ = at[label[at] != label[at + step]]
        close = open_[np.bitwise_count(prints[open_] ^ prints[open_ + step]) <= most]
        if not len(close):
            continue
        found.append((prints[close], prints[close + step]))
        while True:  # the smaller label of each link's two components, until no link joins two
            a, b = label[close], label[close + step]
            if (a == b).all():
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
    if not found:
        return prints[:0], prints[:0]
    left, right = (np.concatenate(x) for x in zip(*found, strict=True))
    return left, right


def _links(buckets: DataFrame, most: int) -> DataFrame:
    """(a, b): fingerprints of one bucket that link."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            lists = batch.column("prints")
            sizes = lists.value_lengths().to_numpy()
            a, b = _needed(lists.flatten().to_numpy().view(np.uint64), sizes, most)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def hamming_links(prints: DataFrame, most: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect every two fingerprints at ``most`` differing bits or fewer.

    ``prints`` holds each fingerprint (``print`` long) once. ``bucket`` must be 2^most at least.
    """
    blocks = _blocks_for(prints.count(), most)
    rows, masks = prints.select(F.lit(0).cast("long").alias("mask"), "print"), {0: choices(0, most, blocks)}
    found: list[DataFrame] = []
    while masks:
        listed = _listed(rows, masks)
        if found:  # two masks may have a successor in common
            listed = listed.distinct()
        hot = hold(listed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket), "hot-buckets")
        cold = listed.join(hot, ["mask", "value"], "left_anti")
        buckets = cold.groupBy("mask", "value").agg(F.collect_list("print").alias("prints")).where(F.size("prints") > 1)
        found.append(hold(_links(buckets.select("prints"), most).distinct(), "hamming-links"))
        again = [r["mask"] & _FULL for r in hot.select("mask").distinct().collect()]  # masks, not rows
        rows = hold(listed.join(hot, ["mask", "value"], "left_semi").select("mask", "print"), "split-again") if again else rows
        masks = {m: choices(m, most, min(most + 2, 64 - m.bit_count())) for m in again}
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def near_duplicates(
    docs: DataFrame, size: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id reachable by links).

    Rows link if their fingerprints differ in ``most`` bits or fewer. A text with fewer words than
    ``size`` is one shingle of them all; null, empty and blank texts have the fingerprint zero, which
    links like any other. Every row is a node of its own: rows that repeat an id with other texts are
    each in their own text's component. Null ids link rows, but are never the smallest; a component of
    null ids alone has the id null. Ids must be whole numbers. Columns of other names are ignored; an
    empty table gives no rows.
    """
    rows = hold(fingerprints(docs, size, id_col, text_col), "fingerprints")
    prints = hold(rows.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    groups = connected_components(hamming_links(prints, most), "a", "b").withColumnsRenamed({"node": "print", "component": "of"})
    placed = prints.join(groups, "print", "left").withColumn("of", F.coalesce("of", "print"))
    placed = hold(placed, "placed")
    smallest = placed.groupBy("of").agg(F.min("least").alias("component_id"))
    named = hold(join_keys(placed, smallest, "of", placed.groupBy("of").agg(F.count(F.lit(1)).alias("n"))), "named")
    out = join_keys(rows, named.select("print", "component_id"), "print", prints.select("print", "n"))
    return out.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, most: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows with the smallest id of each component, all columns; rows with a null id stay."""
    found = near_duplicates(docs, size, most, id_col, text_col)
    [key] = unused(docs.columns, "_gone")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(key)).distinct()
    return docs.join(gone, docs[id_col] == gone[key], "left_anti")
