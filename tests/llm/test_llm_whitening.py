from __future__ import annotations

import math

import numpy as np
import pytest

from supplylens.llm import bidiagonal, whitening
from supplylens.llm.queries import QUERIES


def brute(rows, most=8):
    """{id: (n, deviation)}, eigenvalues, directions and centred rows, by numpy and Python integers."""
    xs = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows]
    n, dims = len(xs), len(xs[0][1])
    sums = [sum(x[k] for _, x in xs) for k in range(dims)]
    deviation = [(i, n, sum((n * x[k] - sums[k]) ** 2 for k in range(dims))) for i, x in xs]
    centred = np.array([[(n * x[k] - sums[k]) / n for k in range(dims)] for _, x in xs])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return deviation, e[::-1], v[:, ::-1][:, :most], centred


def check(found, rows):
    deviation, e, v, centred = brute(rows)
    assert sorted((r.vec_id, r.n, int(r.deviation)) for r in found) == sorted(deviation)
    by_id = {r.vec_id: r for r in found}
    k = len(found[0].whitened)
    want = centred @ v[:, :k] / np.sqrt(e[:k])
    have = np.array([by_id[i].whitened for i, _ in rows])
    signs = np.sign((want * have).sum(axis=0))
    assert np.abs(have - want * signs).max() < 1e-7
    assert all(np.allclose(r.explained, e[:k] / e.sum(), rtol=1e-9) for r in found)
    error = np.abs(have.T @ have / len(rows) - np.eye(k)).max()
    assert all(abs(r.identity_error - error) < 1e-9 and r.identity_error < 1e-9 for r in found)


def test_query_equals_numpy(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = QUERIES["op11_embedding_whitening"](spark, small).collect()
    assert len(found) == 8 * len(rows) and {r.component for r in found} == set(range(1, 9))
    deviation, e, v, centred = brute(rows)
    assert {(r.vec_id, r.n, r.deviation) for r in found} == set(deviation)
    have = {(r.vec_id, r.component): r.whitened for r in found}
    table = np.array([[have[i, c] for c in range(1, 9)] for i, _ in rows])
    want = centred @ v / np.sqrt(e[:8])
    assert np.abs(table - want * np.sign((want * table).sum(axis=0))).max() < 1e-7
    assert all(math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9) for r in found)
    assert {r.identity_error < 1e-9 for r in found} == {True}


SCHEMA = "vec_id long, embedding array<float>, id long, vector string, n long, whitened string, part long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, "w", 3) for i, v in rows], SCHEMA)


def test_awkward_rows_are_dropped_and_the_rest_is_exact(spark):
    rng = np.random.default_rng(2)
    good = [(k, [float(np.float32(c)) for c in rng.standard_normal(5)]) for k in range(200)]
    good += [(7, good[7][1]), (None, good[8][1]), (None, good[8][1])]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [1.0, float("nan"), 0.0, 0.0, 0.0]),
           (904, [float("inf")] * 5), (905, [1.0, 2.0]), (906, [3e38] * 5)]
    found = whitening.whiten(frame(spark, bad[:3] + good + bad[3:]).repartition(7)).collect()
    ids = [r.vec_id for r in found]
    assert len(found) == len(good) and ids.count(7) == 2 and ids.count(None) == 2
    deviation, e, *_ = brute(good)
    assert sorted((r.vec_id or -1, r.n, int(r.deviation)) for r in found) == sorted((i or -1, n, d) for i, n, d in deviation)
    assert np.allclose(found[0].explained, e / e.sum(), rtol=1e-9)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_any_number_of_tasks(spark, partitions):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(c)) for c in rng.standard_normal(6) * [9, 5, 3, 1, 0.5, 0.2]]) for k in range(120)]
    check(whitening.whiten(frame(spark, rows).repartition(partitions), most=4).collect(), rows)


def test_without_variance_or_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    same = whitening.whiten(frame(spark, [(k, [1.0, 2.0]) for k in range(5)])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same] == [(5, 0, [], [], 0.0)] * 5
    flat = whitening.whiten(frame(spark, [(k, [float(k), 2.0 * k, 1.0]) for k in range(9)])).collect()
    assert {len(r.whitened) for r in flat} == {1} and all(abs(r.explained[0] - 1) < 1e-12 for r in flat)


def test_deviation_beyond_a_long_is_exact():
    fit = whitening.Whitening(2, 10**7, [10**12 + 1, -(10**12)], np.eye(2), np.ones(2), 2.0)
    x = np.array([[2**39, -(2**39)]])
    want = (10**7 * 2**39 - 10**12 - 1) ** 2 + (-(10**7) * 2**39 + 10**12) ** 2
    assert whitening._squares(fit.deviations(x)) == [want]


MATRICES = {
    "random": lambda rng: rng.standard_normal((40, 40)),
    "graded": lambda rng: rng.standard_normal((30, 30)) * np.logspace(8, -8, 30),
    "identity": lambda rng: np.eye(20),
    "clusters": lambda rng: np.linalg.qr(rng.standard_normal((20, 20)))[0]
    @ np.diag([5, 5, 5 * (1 - 1e-12), 5 * (1 - 1e-8), 4, 4, 4, 3] + [1] * 12)
    @ np.linalg.qr(rng.standard_normal((20, 20)))[0],
    "rank three": lambda rng: np.linalg.qr(rng.standard_normal((50, 3)) @ rng.standard_normal((3, 20)))[1],
    "one": lambda rng: np.array([[-3.0]]),
    "zero": lambda rng: np.zeros((4, 4)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_values_and_vectors_of_small_matrices(name):
    a = MATRICES[name](np.random.default_rng(8))
    values, vectors = bidiagonal.leading(a, 8)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    large = want > 1e-14 * want.max(initial=0.0)
    assert np.allclose(values[large], want[large], rtol=1e-12)
    k = vectors.shape[1]
    assert k == min(8, int((want > 1e-25 * want.max(initial=0.0)).sum()) if want.max() else 0)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)
    assert np.abs(a.T @ (a @ vectors) - vectors * values[:k]).max(initial=0.0) <= 1e-12 * want.max()
