"""Whitening against a dense eigensolver and exact integers."""

from __future__ import annotations

import numpy as np
import pytest

from changeflow.llm import queries, whitening

TABLE = "vec_id bigint, embedding array<float>"


def reference(vectors):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, turn = np.linalg.eigh(y.T @ y / n)
    far = n * x - sums
    return (far.astype(object) ** 2).sum(axis=1), y, values[::-1], turn[:, ::-1]


def agree(rows, ids, vectors, components):
    deviation, y, values, turn = reference(vectors)
    place = {i: p for p, i in enumerate(ids)}
    assert len(rows) == len(ids) * components
    for k in range(components):
        own = [r for r in rows if r.component == k + 1]
        got = np.empty(len(ids))
        got[[place[r.vec_id] for r in own]] = [r.whitened for r in own]
        want = y @ turn[:, k] / np.sqrt(values[k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert all(abs(r.explained - values[k] / values.sum()) < 1e-12 for r in own)
        assert all(r.deviation == deviation[place[r.vec_id]] and r.n == len(ids) for r in own)
    assert max(r.identity_error for r in rows) < 1e-10


def test_query_over_embeddings(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = queries.op13_embedding_whitening(spark, small).collect()
    agree(rows, [r.vec_id for r in table], [r.embedding for r in table], 8)


def test_unusable_vectors_are_left_out(spark):
    random = np.random.default_rng(1)
    good = random.standard_normal((40, 3)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    odd = [
        (100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]),
        (104, []), (105, [1.0]), (106, [1e30, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], TABLE + ", x string, n int").repartition(3)
    agree(whitening.whiten(df).collect(), [r[0] for r in rows], good, 3)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 5.0]), (2, [0.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, TABLE)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        (i, c) for i in (0, 1, 1, 2) for c in (1, 2)
    )


def test_nothing_to_whiten(spark):
    assert whitening.whiten(spark.createDataFrame([], TABLE)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], TABLE)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], TABLE)).count() == 0


def test_a_deviation_beyond_64_bits_is_null():
    fit = whitening.Whitening(1 << 20, np.array([0]), 1.0, np.ones(1), np.ones((1, 1)))
    assert fit.deviations(np.array([[1 << 14], [3]])) == [None, 9 << 40]


MATRICES = {
    "all equal": np.eye(20) * 5.0,
    "fewer than asked": np.diag([3.0, 2.0, 1.0]),
    "equal beyond the last": np.diag([4.0] * 10 + [1.0] * 3),
    "one": np.array([[2.0]]),
    "close": np.diag(2 - np.arange(40) * 1e-7),
    "far apart": np.diag(10.0 ** -np.arange(12)),
    "one and many close": np.diag([1.0] * 5 + [0.5 - i * 1e-7 for i in range(30)]),
    "rank one and two blocks": np.diag([2.0] * 30 + [1.0] * 30) + 1e-3,
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenpairs(spark, name):
    matrix = MATRICES[name]
    k = min(8, len(matrix))
    values, vectors = whitening.leading_pairs(spark, matrix, k)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], rtol=0, atol=1e-12 * matrix.max())
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-11
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-9


def test_inertia_counts():
    random = np.random.default_rng(3)
    square = random.standard_normal((30, 30))
    matrix = square @ square.T
    values = np.linalg.eigvalsh(matrix)
    shifts = np.concatenate([values[:-1] + np.diff(values) / 2, [values[0] - 1, values[-1] + 1]])
    counts = whitening.counts_above(*whitening.tridiagonal(matrix), shifts)
    assert counts.tolist() == [(values > s).sum() for s in shifts]
