"""Embedding whitening: QR of centred rows by blocks, then a bidiagonal qd solver for the small factor.

1. Entries become whole numbers, floor(1024 c) + 100000, so sums and deviations are exact.
2. Every task reduces its centred rows, block by block, to one triangle R with R'R = the sum of their
   products. Triangles are stacked and reduced again, ``FAN`` at a time, until one is left: the driver
   sees one d x d matrix, whatever the rows.
3. ``bidiagonal.leading``: Householder bidiagonal form, singular values by dqds, directions by twisted
   factorisations.
4. Rows are projected; a further pass over all of them measures the covariance of what comes out,
   merging the tasks' means and centred products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold
from .bidiagonal import leading
from .shipping import ship

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**30  # of an entry; sums of a task's x stay within a long
FAN = 16


def whole_numbers(lists: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, x): the rows whose vector is complete, as longs floor(1024 c) + 100000.

    Complete: not null, not empty, no entry null, not finite or of ``LARGEST`` and more, and ``dims`` entries
    where that is given.
    """
    valid = pc.is_valid(lists).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = pc.cast(pc.list_flatten(lists), pa.float64())
    filled = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    good = valid & (sizes > 0) & (np.bincount(owner[~(np.abs(filled) < LARGEST)], minlength=len(sizes)) == 0)
    if dims is None:
        return np.flatnonzero(good), np.empty((0, 0), dtype=np.int64)
    good &= sizes == dims
    flat = filled[np.repeat(good, sizes)]
    return np.flatnonzero(good), np.floor(SCALE * flat).astype(np.int64).reshape(-1, dims) + SHIFT


def _dims(rows: DataFrame) -> int:
    """The most frequent length of a complete vector, the larger one where two are as frequent; 0 without any."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            lists = batch.column("vector")
            good, _ = whole_numbers(lists)
            sizes, many = np.unique(pc.list_value_length(lists).to_numpy(zero_copy_only=False)[good], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes.astype(np.int64)), pa.array(many)], names=["dims", "n"])

    counted = rows.select("vector").mapInArrow(run, "dims long, n long").groupBy("dims").agg(F.sum("n").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("dims")).first()
    return int(first["dims"]) if first else 0


def _sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows and per-dimension sums of x, exact."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=np.int64)
        for batch in table:
            _, x = whole_numbers(batch.column("vector"), dims)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dims)), pa.array(np.append([n], total))], names=["dim", "total"]
        )

    parts = rows.select("vector").mapInArrow(run, "dim long, total long")
    # one row for each dimension
    found = dict(parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("s")).collect())
    return int(found.get(-1) or 0), [int(found.get(k) or 0) for k in range(dims)]


@dataclass
class Whitening:
    """A fitted whitening: ``n`` rows, ``sums`` per dimension, directions as columns and their values.

    ``values`` are the covariance's eigenvalues that belong to ``directions``, ``trace`` is the sum of all.
    """

    dims: int
    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; as Python integers where a long might not hold it."""
        widest = max(self.n * int(np.abs(x).max(initial=0)), max(map(abs, self.sums), default=0))
        if widest < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return self.deviations(x).astype(float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.directions) / np.sqrt(self.values)


def _squares(deviations: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    top = int(np.abs(deviations).max(initial=0))
    if top * top * max(deviations.shape[1], 1) < 1 << 63:
        d = deviations.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = deviations.astype(object)
    return [int(v) for v in (d * d).sum(axis=1)]


def _triangle(parts: Iterator[np.ndarray], dims: int) -> np.ndarray:
    """The triangle of all rows of all parts together."""
    r = np.zeros((0, dims))
    for part in parts:
        r = np.linalg.qr(np.vstack([r, part]), mode="r")
    return r


def _reduced(rows: DataFrame, fit: Whitening) -> np.ndarray:
    """R of the centred rows, dims x dims."""
    dims = fit.dims
    schema = "part long, r binary"

    def blocks(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = _triangle((fit.centred(whole_numbers(b.column("vector"), dims)[1]) for b in table), dims)
        number = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    def stacked(table: pa.Table) -> pa.Table:
        parts = (np.frombuffer(x, dtype=float).reshape(-1, dims) for x in table.column("r").to_pylist())
        r = _triangle(parts, dims)
        return pa.table({"part": table.column("part")[:1], "r": pa.array([r.tobytes()], pa.binary())})

    held = hold(rows.select("vector").mapInArrow(blocks, schema), "triangles")
    widest = held.agg(F.max("part")).first()[0]
    while widest:
        held = hold(
            held.withColumn("part", F.expr(f"part div {FAN}")).groupBy("part").applyInArrow(stacked, schema), "triangles"
        )
        widest = held.agg(F.max("part")).first()[0]
    r = np.zeros((dims, dims))
    for row in held.collect():  # one row
        found = np.frombuffer(row["r"], dtype=float).reshape(-1, dims)
        r[: len(found)] = found
    return r


def fit(vectors: DataFrame, most: int = 8, vector_col: str = "embedding") -> Whitening | None:
    """The whitening of a table's complete vectors, ``most`` components; None without any.

    Components have falling eigenvalues; directions without variance are none, so there may be fewer.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(vector_col).alias("vector"))
    dims = _dims(rows)
    if not dims:
        return None
    n, sums = _sums(rows, dims)
    found = Whitening(dims, n, sums, np.empty((dims, 0)), np.empty(0), 0.0)
    r = _reduced(rows, found)
    values, directions = leading(r, min(most, dims))
    found.directions, found.values = directions, values[: directions.shape[1]] / n
    found.trace = float((r * r).sum()) / n
    return found


def identity_error(vectors: DataFrame, found: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = found.directions.shape[1]

    def moments(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in table:
            w = found.whitened(whole_numbers(batch.column("vector"), found.dims)[1])
            if not len(w):
                continue
            own = w.mean(axis=0)
            n, mean, products = _merged(n, mean, products, len(w), own, (w - own).T @ (w - own))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])], names=["n", "mean", "products"]
        )

    rows = vectors.select(F.col(vector_col).alias("vector"))
    parts = hold(rows.mapInArrow(moments, "n long, mean array<double>, products array<double>"), "moments")
    # the mean of all, then every part's products moved to it: sums of k + k * k numbers
    n = F.col("n")
    total = parts.agg(F.sum("n").alias("n"), *[F.sum(n * F.col("mean")[i]).alias(f"m{i}") for i in range(k)]).first()
    if not k or not total["n"]:
        return 0.0
    mean = [total[f"m{i}"] / total["n"] for i in range(k)]
    away = [F.col("mean")[i] - F.lit(mean[i]) for i in range(k)]
    cov = parts.agg(
        *[(F.sum(F.col("products")[i * k + j] + n * away[i] * away[j]) / total["n"]).alias(f"c{i}_{j}") for i in range(k) for j in range(k)]
    ).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(k))


def _merged(
    n: int, mean: np.ndarray, products: np.ndarray, m: int, other: np.ndarray, more: np.ndarray
) -> tuple[int, np.ndarray, np.ndarray]:
    """Means and centred products of two sets of rows together."""
    apart = other - mean
    return n + m, mean + apart * (m / (n + m)), products + more + np.outer(apart, apart) * (n * m / (n + m))


def whiten(vectors: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per complete vector: id, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, or hold an entry that is null, not finite or of 2^30 and more are dropped,
    as are those of another length than most have. Each entry c is taken as x = floor(1024 c) + 100000.
    ``n`` counts the rows; ``deviation`` (decimal, null beyond 38 digits) is the sum over dimensions of
    (n x - S)^2, exact;
    ``whitened`` holds a number for each component, (x - S/n) along its direction over the root of its
    eigenvalue; ``explained`` holds each eigenvalue's share of the trace; ``identity_error`` is the largest
    entry of the whitened rows' covariance beside the identity. Components are at most ``most``, less where
    fewer directions have variance (none for equal rows or a single one); equal eigenvalues share a
    space, in which any directions are as good. Repeated ids are rows of their own; columns of
    other names are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    found = fit(rows, most, "vector")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if found is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(rows, found, "vector")
    explained = (found.values / found.trace).tolist() if found.trace else []

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in table:
            at, x = whole_numbers(batch.column("vector"), found.dims)
            squares = _squares(found.deviations(x))
            m, k = len(at), len(explained)
            offsets = np.arange(0, (m + 1) * k, k, dtype=np.int32) if k else np.zeros(m + 1, dtype=np.int32)
            whitened = pa.ListArray.from_arrays(offsets, pa.array(found.whitened(x).ravel()))
            shares = pa.ListArray.from_arrays(offsets, pa.array(np.tile(np.array(explained), m)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(at)), pa.array(np.full(m, found.n)),
                    pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0)), whitened, shares,
                    pa.array(np.full(m, error)),
                ],
                names=["id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
