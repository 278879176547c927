"""Passages that repeat across documents, by a sparse suffix array.

A passage is at least ``LEAST`` words in a row, letters A-Z taken as a-z, that stand in two or more
documents.

1. Sparse suffixes. Among every ``LEAST`` words the 16-gram with the smallest fingerprint is kept,
   so two texts that share ``LEAST`` words keep the same suffix there. About one suffix in 18 words
   stays. Each is written with the stretch of windows that chose it.
2. Sort and compare neighbours. Suffixes are sorted by their 16-gram, then by what follows and what
   precedes within their stretch, then by document. Neighbours with an equal stretch repeat all of
   it. Where the stretch changes but not the 16-gram, the two may share a part: both go on to the
   next step, a group of equal stretches as its first and last document alone.
3. Extend left and right. For these the text is read once more, and from the suffix every window to
   the left and right that still holds it is compared in the same way, sorted against its
   neighbours. This finds the exact word where a repeat begins and ends.

A stretch's windows are exactly those that chose the suffix, so every window of every text is
compared, through one suffix, and the union of the windows that repeat is the passage. Each row is
judged by its neighbours and a number carried from row to row; the sort key ends in the document,
so Spark's range partitioning splits a passage that a third of all documents hold. Rows at the
edges of partitions, two of each, are matched up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold
from . import kept
from .names import unused
from .shipping import ship
from .text import LOWER, raw_texts, slices, span_hashes, window_hashes, word_bounds, word_hashes

LEAST = 50
_GRAM = 16
#: Bytes of text whose windows a task holds at once; a word may give a window of 36 bytes.
_WINDOW_BYTES = 1_000_000
_ORDER = ("key", "right", "left", "doc")
_ROWS = "key long, right long, left long, doc long, lo int, hi int"


def sparse_suffixes(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """16-gram, place, first and last window of every kept suffix; windows are ``least`` words."""
    gram = min(_GRAM, least)
    grams = window_hashes(words, gram)
    if len(words) < least:
        return grams[:0], *[np.empty(0, dtype=np.int64)] * 3
    windows = np.lib.stride_tricks.sliding_window_view(grams, least - gram + 1)
    chosen = windows.argmin(axis=1) + np.arange(len(windows))
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], len(chosen)) - 1
    return grams[chosen[first]], chosen[first], first, last


def _batch(*columns) -> pa.RecordBatch:
    key, right, left, doc, lo, hi = columns
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(right.view(np.int64)), pa.array(left.view(np.int64)),
            pa.array(doc, pa.int64()), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
        ],
        names=["key", "right", "left", "doc", "lo", "hi"],
    )


def _suffix_rows(texts: DataFrame, least: int) -> DataFrame:
    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("suffix_dedup")
        for whole in table:
            for batch in slices(whole, "text"):
                out = []
                for doc, raw in zip(batch.column("doc").to_pylist(), raw_texts(batch.column("text")), strict=True):
                    words = word_hashes(raw)
                    key, at, lo, hi = sparse_suffixes(words, least)
                    if len(key):
                        right = span_hashes(words, at, hi + least)
                        out.append((key, right, span_hashes(words, lo, at), np.full(len(key), doc), lo, hi))
                if out:
                    yield _batch(*(np.concatenate(x) for x in zip(*out, strict=True)))
        kept.give_back()

    return texts.mapInArrow(run, _ROWS)


class _Neighbours:
    """Judges sorted rows by their neighbours, a partition's batches one after the other.

    Rows of one document with equal keys form a run, runs with equal keys a group. A run repeats if
    the one before or after it is of its group; it is near if one of them has an equal 16-gram.
    ``keeper`` is the group's first document. Where a group ends and the 16-gram goes on, the group
    is represented by a row of its keeper and one of its last document (one of the two is another
    document than any that shares a part). A batch's last run waits for the next batch.
    """

    def __init__(self) -> None:
        self.before: tuple | None = None  # keys of the run before the waiting rows
        self.keeper = (0, 0, 0)  # first document of the group of ``before``, with its windows
        self.turned = True  # the 16-gram came before the group of ``before``, or may have
        self.opening = True  # no group but the partition's first has been seen

    def judge(self, rows: pa.Table, final: bool) -> tuple[pa.Table, pa.Table | None]:
        keys = [rows.column(c).to_numpy() for c in ("key", "right", "left")]
        doc = rows.column("doc").to_numpy()
        changed = np.zeros(len(doc), dtype=bool)
        changed[0] = True
        for c in (*keys, doc):
            changed[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(changed)
        run_keys = [k[starts] for k in keys]
        run_doc = doc[starts]
        n = len(starts)
        same_before, near_before = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        near_before[1:] = run_keys[0][1:] == run_keys[0][:-1]
        same_before[1:] = near_before[1:]
        for k in run_keys[1:]:
            same_before[1:] &= k[1:] == k[:-1]
        if self.before is not None:
            near_before[0] = run_keys[0][0] == self.before[0]
            same_before[0] = all(k[0] == b for k, b in zip(run_keys, self.before, strict=True))
        same_after, near_after = np.append(same_before[1:], False), np.append(near_before[1:], False)

        begins = np.maximum.accumulate(np.where(same_before, -1, np.arange(n)))
        keeper, keeper_lo, keeper_hi = (
            np.where(begins >= 0, c[starts][np.maximum(begins, 0)], kept)
            for c, kept in zip((doc, rows.column("lo").to_numpy(), rows.column("hi").to_numpy()), self.keeper, strict=True)
        )
        if self.before is None:
            opening = np.cumsum(~same_before) <= 1
        else:
            opening = np.full(n, self.opening) & (np.cumsum(~same_before) == 0)
        closing = np.zeros(n, dtype=bool)
        closing[-1] = final
        done = n if final else n - 1
        if done:
            self.before = tuple(k[done - 1] for k in run_keys)
            self.keeper = tuple(int(k[done - 1]) for k in (keeper, keeper_lo, keeper_hi))
            self.opening = bool(opening[done - 1])
        edge = opening | closing
        turned = np.where(begins >= 0, near_before[np.maximum(begins, 0)], self.turned) | opening
        if done:
            self.turned = bool(turned[done - 1])
        turns = (near_before & ~same_before) | (near_after & ~same_after) | edge
        shown = np.flatnonzero((turns & (same_before | same_after))[:done])
        ends = np.flatnonzero((same_before & ~same_after & (turned | near_after | edge))[:done])
        own_lo, own_hi = (rows.column(c).to_numpy()[starts[ends]] for c in ("lo", "hi"))
        same = same_before | same_after
        near = near_before | near_after | edge
        of_row = np.cumsum(changed) - 1
        cut = len(doc) if final else int(starts[-1])
        first_of_run = changed[:cut]
        of_row = of_row[:cut]
        judged = rows.slice(0, cut)
        for name, x in (("same", same), ("near", near), ("keeper", keeper), ("edge", edge)):
            judged = judged.append_column(name, pa.array(x[of_row]))
        judged = judged.append_column("lead", pa.array(edge[of_row] & first_of_run))
        judged = judged.append_column("stands_for", pa.array(np.zeros(cut, dtype=bool)))
        judged = judged.filter(pa.array((same | near)[of_row]))
        at = np.concatenate([shown, ends])
        no = np.zeros(len(at), dtype=bool)
        groups = pa.table(
            [
                *[pa.array(k[at]) for k in run_keys], pa.array(np.concatenate([keeper[shown], run_doc[ends]])),
                pa.array(np.concatenate([keeper_lo[shown], own_lo]).astype(np.int32)),
                pa.array(np.concatenate([keeper_hi[shown], own_hi]).astype(np.int32)),
                pa.array(no), pa.array(~no), pa.array(keeper[at]), pa.array(no), pa.array(no), pa.array(~no),
            ],
            schema=judged.schema,
        )
        return pa.concat_tables([judged, groups]), None if final else rows.slice(cut)


def _compared(rows: DataFrame, label: str) -> DataFrame:
    """The rows that have something in common with a neighbour: keys, doc, lo, hi, same, keeper, stands_for."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("suffix_dedup")
        state, waiting = _Neighbours(), None
        for batch in table:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            part = part if waiting is None else pa.concat_tables([waiting, part])
            judged, waiting = state.judge(part.combine_chunks(), final=False)
            yield from judged.to_batches()
        if waiting is not None:
            yield from state.judge(waiting.combine_chunks(), final=True)[0].to_batches()
        kept.give_back()

    schema = f"{_ROWS}, same boolean, near boolean, keeper long, edge boolean, lead boolean, stands_for boolean"
    judged = hold(rows.orderBy(*_ORDER).mapInArrow(run, schema), label)
    # a group cut by partitions has led runs on both sides of the cut; two groups of a partition at most
    border = judged.where("lead").groupBy("key", "right", "left").agg(
        F.min("keeper").alias("_keeper"), F.max("doc").alias("_most")
    )
    whole = judged.join(F.broadcast(border), ["key", "right", "left"], "left")
    beyond = F.col("edge") & ~F.col("same")  # what lies beyond the edge is not known: look into it
    return whole.select(
        "key", "right", "left", "doc", "lo", "hi",
        (F.col("same") | F.coalesce(F.col("_keeper") < F.col("_most"), F.lit(False))).alias("same"),
        F.least("keeper", "_keeper").alias("keeper"),
        (F.col("stands_for") | beyond).alias("stands_for"),
    )


def _windows(texts: DataFrame, partial: DataFrame, least: int) -> DataFrame:
    """Every window of the stretches that repeat in part, from the text itself; hi is where its stretch begins."""
    wanted = partial.groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("stretches"))  # one document's
    wanted = hold(wanted, "stretches")

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("suffix_dedup")
        for whole in table:
            for batch in slices(whole, "text", _WINDOW_BYTES):
                out = []
                columns = (batch.column("doc").to_pylist(), raw_texts(batch.column("text")), batch.column("stretches").to_pylist())
                for doc, raw, stretches in zip(*columns, strict=True):
                    words = word_hashes(raw)
                    starts = np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in stretches])
                    begins = np.repeat([s["lo"] for s in stretches], [s["hi"] + 1 - s["lo"] for s in stretches])
                    begins, starts = begins[starts + least <= len(words)], starts[starts + least <= len(words)]
                    key = span_hashes(words, starts, starts + least)
                    none = np.zeros(len(key), dtype=np.uint64)
                    out.append((key, none, none, np.full(len(key), doc), starts, begins))
                if out:
                    yield _batch(*(np.concatenate(x) for x in zip(*out, strict=True)))
        kept.give_back()

    return texts.join(wanted, "doc").select("doc", "text", "stretches").mapInArrow(run, _ROWS)


def _firsts(stretches: DataFrame, windows: DataFrame) -> DataFrame:
    """The smallest document that any window of a group's stretch stands in, where it is none of the group.

    Rows (key, right, left, _first). Only a group's representatives are compared window by window;
    this is what they find for all members.
    """
    standing = stretches.where("stands_for").select("key", "right", "left", "doc", F.col("lo").alias("begin"), "keeper")
    least = windows.groupBy("doc", F.col("hi").alias("begin")).agg(F.min("keeper").alias("_first"))
    found = standing.join(least, ["doc", "begin"]).where("_first < keeper")
    return hold(found.groupBy("key", "right", "left").agg(F.min("_first").alias("_first")), "firsts")


def _joined(lo: np.ndarray, hi: np.ndarray, keeper: np.ndarray) -> list[dict]:
    """Word ranges as few as they can be, each with the smallest keeper of its parts."""
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    lo, hi, keeper = lo[order], np.maximum.accumulate(hi[order]), keeper[order]
    first = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    last = np.append(first[1:], len(lo)) - 1
    least = np.minimum.reduceat(keeper, first)
    return [
        {"start": int(a), "end": int(b), "keeper": int(k)} for a, b, k in zip(lo[first], hi[last], least, strict=True)
    ]


_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("keeper", pa.int64())]))


def _ranges(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    """Passages and cuts of documents from their parts (lo, hi, keeper, first), read as arrays."""
    passages, cuts = [], []
    parts = batch.column("parts")
    ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    columns = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in parts.flatten().flatten()]
    for doc, begin, end in zip(batch.column("doc").to_pylist(), ends[:-1], ends[1:], strict=True):
        lo, hi, keeper, first = (x[begin:end] for x in columns)
        other = keeper < doc
        passages.append(_joined(lo, hi + least, first))
        cuts.append(_joined(lo[other], hi[other] + least, first[other]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc"), pa.array(passages, _RANGES), pa.array(cuts, _RANGES)], names=["doc", "passages", "cuts"]
    )


def repeated_passages(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a repeated passage: id, passages, cuts.

    passages: word ranges (start, end exclusive) that stand in another document too, and the smallest
    id that any part of them stands in. cuts: the part of them that stands in a document of smaller
    id, so that taking out all cuts leaves every passage in one place. Repeats inside one document
    alone are none. Ids must be whole numbers. Null ids take no part; null, empty and shorter texts have no passages. Rows that
    repeat an id with the same text count as one document. Columns of other names are ignored; an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(
        "doc is not null and text is not null"
    )
    suffixes = hold(_suffix_rows(texts, least), "suffixes")
    compared = hold(_compared(suffixes, "neighbours"), "compared")
    windows = hold(_windows(texts, compared.where("not same or stands_for"), least), "windows")
    matched = hold(_compared(windows, "window-neighbours").where("same").select("doc", "lo", "hi", "keeper"), "matched")
    # what a group cuts goes by its own first document, what it reports by that of its windows
    members = compared.where("same").join(_firsts(compared, matched), ["key", "right", "left"], "left").select(
        "doc", "lo", "hi", "keeper", F.least("keeper", "_first").alias("first")
    )
    found = members.union(matched.select("doc", "lo", "lo", "keeper", "keeper"))
    by_doc = found.groupBy("doc").agg(F.collect_set(F.struct("lo", "hi", "keeper", "first")).alias("parts"))  # one document's

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("suffix_dedup")
        for batch in table:
            yield _ranges(batch, least)
        kept.give_back()

    ranges = "array<struct<start:int,end:int,keeper:long>>"
    return by_doc.mapInArrow(run, f"doc long, passages {ranges}, cuts {ranges}").withColumnRenamed("doc", id_col)


def without(text: str, cuts: list) -> str:
    """The text without these word ranges, nor the white space that follows them."""
    raw = text.encode("utf-8")
    starts, ends = word_bounds(raw.translate(LOWER))
    out, at = [], 0
    for cut in cuts:
        out.append(raw[at : starts[cut["start"]]])
        at = starts[cut["end"]] if cut["end"] < len(starts) else ends[-1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8")


def cut_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, each repeated passage left only in the document of smallest id.

    Texts without cuts stay as they are; a document with no word left goes.
    """
    cuts = repeated_passages(docs, least, id_col, text_col).where(F.size("cuts") > 0)
    [doc, own] = unused(docs.columns, "_doc", "_cuts")
    cuts = hold(cuts.select(F.col(id_col).alias(doc), F.col("cuts").alias(own)), "cuts")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else without(t, list(r)) for t, r in zip(texts, ranges, strict=True)])

    touched = docs.join(cuts, docs[id_col] == cuts[doc]).withColumn(text_col, cut(F.col(text_col), F.col(own)))
    touched = touched.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(docs.columns)
    untouched = docs.join(cuts, docs[id_col] == cuts[doc], "left_anti")
    return untouched.unionByName(touched)
