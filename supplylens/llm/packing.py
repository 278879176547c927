"""Best-fit packing with certified partitions.

Pieces are dealt at random into groups of about ``GROUP`` rows, each packed by best-fit decreasing
in one task. Dual-feasible functions give every group a lower bound on its sequences: a group that
meets its bound is certified, no packing of these pieces has fewer. What can still be gained is
then pooled and packed anew:

* a group with a gap between its count and its bound gives up the pieces of all sequences with room;
* a certified group gives up its emptiest sequence only (its pieces may fill others' room).

The pool is dealt out again, so pieces of different groups meet, and packed in the same way. It is
taken over if it needs fewer sequences than before, and rounds end when it does not, when the pool
came from one group, or after ``rounds``. A round reads only the pool, a group has a fixed size and
the driver sees three sums per round, so the work per round never grows beyond one pass.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold
from .shipping import ship
from .word_tokens import token_pieces

GROUP = 8192  # pieces that one task packs together


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by dual-feasible functions of length over capacity.

    Two families: one rounds lengths over capacity - q up to a whole sequence and drops those under
    q, for every q up to a half; the other rounds (k + 1) * length / capacity down to a multiple of
    1 / k unless it is whole already. Each keeps the sum of any full sequence at 1 or less, so the
    rounded total is a bound. All arithmetic is on integers.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    rows, tokens = np.cumsum(counts), np.cumsum(counts * sizes)
    q = np.arange(capacity // 2 + 1)
    below = np.where(q > 0, tokens[np.maximum(q, 1) - 1], 0)
    large = rows[-1] - rows[capacity - q]
    best = int((large + -(-(tokens[capacity - q] - below) // capacity)).max())
    for k in range(1, 65):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and each sequence's room; ties go to the earlier row."""
    place = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    room: list[int] = []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some sequence has room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            held = with_room[r]
            s = held.pop()
            if not held:
                rooms ^= 1 << r
        else:
            s, r = len(room), capacity
            room.append(r)
        place[k], offset[k] = s, capacity - r
        left = room[s] = r - size
        if left:
            if not with_room.setdefault(left, []):
                rooms |= 1 << left
            with_room[left].append(s)
    return place, offset, np.array(room, dtype=np.int64)


def _round(pieces: DataFrame, number: int, groups: int, capacity: int) -> DataFrame:
    """Deal (row, length) into groups and pack each; adds place, offset, bins, bound, pooled."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        lengths = table.column("length").to_numpy()
        place, offset, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        pooled = room > 0
        if len(room) <= bound:  # certified
            pooled = np.zeros(len(room), dtype=bool)
            pooled[room.argmax()] = room.max() > 0
        first = np.zeros(len(place), dtype=bool)
        first[np.unique(place, return_index=True)[1]] = True
        return pa.table(
            {
                "row": table.column("row"), "length": table.column("length"),
                "sequence_id": (number << 58) | (table.column("deal").to_numpy() << 24) | place,
                "offset": offset, "first": first, "pooled": pooled[place],
                "gap": np.where(np.arange(len(place)) == 0, len(room) - bound, 0),
            }
        )

    dealt = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)).alias("deal"))
    return dealt.groupBy("deal").applyInArrow(
        pack, "row long, length long, sequence_id long, offset long, first boolean, pooled boolean, gap long"
    )


def pack(pieces: DataFrame, capacity: int, rounds: int = 4) -> DataFrame:
    """(row, sequence_id, offset) for pieces (row, length): row unique, 1 <= length <= capacity."""
    ship(pieces.sparkSession)
    placed: list[DataFrame] = []
    pool, rows, before = pieces, pieces.count(), None
    for number in range(rounds):
        groups = max(1, math.ceil(rows / GROUP))
        packed = hold(_round(pool, number, groups, capacity), f"packed-{number}")
        sums = packed.agg(
            F.count_if("first").alias("used"), F.count_if("pooled").alias("rows"),
            F.count_if(F.col("first") & F.col("pooled")).alias("pooled"),
        ).first()
        if before is not None and sums["used"] >= before:  # the exchange gained nothing
            placed[-1] = last
            break
        last, before, rows = packed, sums["pooled"], sums["rows"]
        placed.append(packed.where("not pooled"))
        pool = packed.where("pooled")
        if groups == 1 or number == rounds - 1 or not rows:
            placed[-1] = packed
            break
    return reduce(DataFrame.unionByName, placed).select("row", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int | None = 1,
    give: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, what ``give`` makes of ids, sequence_id, offset.

    ``give`` is the ids themselves by default (binary, little-endian uint32). A null or empty text
    is its end id alone. Repeated rows are packed one by one; ties in length go by row order. Other
    columns, whatever their names, are ignored. An empty table gives no rows.
    """
    give = give or {"ids": F.col("ids")}
    tokens = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    pieces = hold(
        tokens.select(
            F.monotonically_increasing_id().alias("_row"), id_col, "piece", "start", "length",
            *[c.alias(n) for n, c in give.items()],
        ),
        "pieces",
    )
    placed = pack(pieces.select(F.col("_row").alias("row"), "length"), capacity)
    return pieces.join(placed.withColumnRenamed("row", "_row"), "_row").drop("_row")
