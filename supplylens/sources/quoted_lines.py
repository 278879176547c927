"""Records of a CSV file whose quoted fields hold line breaks, read by many tasks.

Whether a line begins a record depends on the quotes of all lines before it. Every split of a file
counts its quotes first; a prefix over these counts says for each split whether it begins inside a
quoted field. Then each split finds its own records. A record that a border cuts is put together
from the pieces: the open end of one split, splits that lie inside the record whole, and the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.workspace import hold
from ..operators.quality import DataQualityError

WHOLE, REST, OPEN = 0, 1, 2  # a record, lines that belong to one of an earlier split, one that goes on
_PIECES = "file string, block long, seq long, kind int, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block) of every line; block is the first byte of its split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _states(lines: DataFrame, path: str) -> DataFrame:
    """(file, block, inside): whether each split begins inside quotes. A row for each split."""
    counted = hold(
        lines.groupBy("file", "block").agg(F.sum(F.regexp_count("value", F.lit('"'))).alias("quotes")), "quotes"
    )
    unclosed = counted.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1")
    if not unclosed.isEmpty():
        raise DataQualityError(f"{path} has a quote that is not closed")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return counted.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _pieces(lines: DataFrame, states: DataFrame) -> DataFrame:
    """(file, block, seq, kind, record) of all records and pieces; seq counts a split's own records from 0."""
    numbered = lines.withColumn("number", F.monotonically_increasing_id())
    placed = numbered.join(states, ["file", "block"], "left")
    # another number of cores between the two scans may cut the file elsewhere
    lost = F.raise_error(F.lit("the file was split in another way than when its quotes were counted")).cast("boolean")
    known = placed.withColumn("inside", F.coalesce("inside", lost)).sortWithinPartitions("number")

    class Split:
        """The lines of one split as they come, in order; gives its records and pieces."""

        def __init__(self, inside: bool):
            self.parity = int(inside)
            self.kind, self.seq = (REST, -1) if inside else (WHOLE, 0)
            self.waiting: list[str] = []  # lines of a record whose end has not been seen

        def take(self, values: pa.Array) -> tuple[list[int], list[int], list[str]]:
            """(seq, kind, record) of what these lines complete."""
            quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
            after = (self.parity + np.cumsum(quotes)) % 2
            ends = np.flatnonzero(after == 0)  # lines after which no quote is open
            lines, seqs, kinds, out = values.to_pylist(), [], [], []
            at = 0
            for end in ends.tolist():
                record = lines[end] if end == at and not self.waiting else "\n".join([*self.waiting, *lines[at : end + 1]])
                self.waiting, at = [], end + 1
                if self.kind == REST or record.strip():  # a line of nothing is no record
                    seqs.append(self.seq)
                    kinds.append(self.kind)
                    out.append(record)
                    self.seq += 1
                self.kind, self.seq = WHOLE, max(self.seq, 0)
            self.waiting += lines[at:]
            self.parity = int(after[-1]) if len(after) else self.parity
            return seqs, kinds, out

        def finish(self) -> tuple[list[int], list[int], list[str]]:
            """What is open at the split's end: a record that goes on, or lines inside one that began earlier."""
            if not self.waiting:
                return [], [], []
            return [self.seq], [REST if self.kind == REST else OPEN], ["\n".join(self.waiting)]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(file: str, block: int, seqs: list, kinds: list, records: list) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(seqs, pa.int64()),
                    pa.array(kinds, pa.int32()), pa.array(records, pa.string()),
                ],
                names=["file", "block", "seq", "kind", "record"],
            )

        key, split = None, None
        for rows in table:
            files, blocks = rows.column("file").to_pylist(), rows.column("block").to_numpy()
            first = [k for k in range(rows.num_rows) if k == 0 or blocks[k] != blocks[k - 1] or files[k] != files[k - 1]]
            for lo, hi in zip(first, [*first[1:], rows.num_rows], strict=True):
                now = files[lo], int(blocks[lo])
                if now != key:
                    if split is not None:
                        yield batch(*key, *split.finish())
                    key, split = now, Split(rows.column("inside")[lo].as_py())
                yield batch(*key, *split.take(rows.column("value").slice(lo, hi - lo)))
        if split is not None:
            yield batch(*key, *split.finish())

    return known.select("file", "block", "inside", "value").mapInArrow(run, _PIECES)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record, its text with the line breaks inside quotes, without the headers.

    The first record of each file is its header. Lines of nothing are none, and the carriage return at
    the end of a record goes. Fails if a file's quotes do not pair up.
    """
    lines = _lines(spark, path)
    pieces = hold(_pieces(lines, hold(_states(lines, path), "splits")), "records")
    cut = pieces.where(F.col("kind") != WHOLE)  # two rows of each split at most
    in_order = W.partitionBy("file").orderBy("block", "kind")
    chains = cut.withColumn("chain", F.sum((F.col("kind") == OPEN).cast("int")).over(in_order))
    joined = chains.groupBy("file", "chain").agg(
        F.array_sort(F.collect_list(F.struct("block", "kind", "seq", "record"))).alias("parts")
    )
    whole = joined.select(
        F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["seq"].alias("seq"),
        F.array_join(F.col("parts.record"), "\n").alias("record"),
    )
    found = pieces.where(F.col("kind") == WHOLE).select("block", "seq", "record").unionByName(whole)
    return found.where("not (block = 0 and seq = 0)").select(F.regexp_replace("record", "\r$", "").alias("record"))
