"""Whitening of embeddings along the leading eigenvectors of their covariance.

Spark sums the vectors and their centred products over all rows; what is left is
one matrix of dimension x dimension.  Its leading eigenpairs come from contour
integration: complex shifted solves (z I - V) X = Y at quadrature points of a
circle, summed, project Y onto the eigenvectors whose eigenvalues lie inside;
Rayleigh-Ritz on that subspace extracts them, and the projection is repeated until
the residuals vanish.  The solves are Spark tasks, one per circle and point.  The
inertia of V - s I (how many eigenvalues are above s) places the circles' ends in
gaps and says how many eigenvalues each has to give, so none is missed.

Driver and tasks hold a few matrices of dimension x dimension, whatever the number
of rows; ``MAX_DIMENSION`` bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DIMENSION = 4096
COMPONENTS = 8
#: Entries are whole numbers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no place in fixed point; such vectors are left out.
LIMIT = 2.0**20
#: An eigenvalue below this share of the trace is rounding error of a zero.
ZERO = 1e-12
#: Quadrature points on the upper half of a circle; eigenvalues per circle.
POINTS, PER_CIRCLE = 8, 4
#: Eigenvalues closer than this share of the largest row sum are taken together.
EQUAL = 1e-9
#: How far beyond the last component a gap is looked for.
BEYOND = 8
RESIDUAL, MAX_ROUNDS = 1e-13, 30


@dataclass(frozen=True)
class Whitening:
    """n vectors with the per-dimension sums, the covariance's trace and leading eigenpairs.

    ``vectors`` has a component per column; ``values`` fall.
    """

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, in doubles; whole parts are taken off exactly first."""
        return _centred(x, self.sums, self.n)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sums)**2; None where a 64-bit integer cannot hold it."""
        if len(x) == 0:
            return []
        far = self.n * x.astype(object) - self.sums.astype(object) if self.n >= 1 << 31 else self.n * x - self.sums
        largest = max(int(np.abs(far).max()), 1)
        if largest**2 * x.shape[1] < 1 << 63:
            return (far.astype(np.int64) ** 2).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in far.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    whole = sums // n
    return (x - whole).astype(np.float64) - (sums - whole * n) / n


def fixed_point(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable vectors, x being whole numbers.

    Left out: vectors that are null or empty, with entries null, not finite or of
    ``LIMIT`` and more, or of another length than most (of equally frequent lengths
    the larger counts).  Repeated rows and null ids stay.
    """
    entry = F.col("v")
    usable = embeddings.select(
        F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")
    ).where(
        entry.isNotNull() & (F.size(entry) > 0)
        & F.coalesce(F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)), F.lit(False))
    )
    lengths = usable.groupBy(F.size("v").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dimension = most[0]["d"] if most else 0
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; at most {MAX_DIMENSION} are supported")
    whole = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint") + F.lit(SHIFT))
    return usable.where(F.size("v") == dimension).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(0)).sum(axis=0)
                n, total = n + batch.num_rows, own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()])], names=["n", "s"])

    parts = vectors.select("x").mapInArrow(add, "n bigint, s array<bigint>")
    found = parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")
    ).orderBy("i").collect()
    return (found[0]["n"] if found else 0), np.array([r["s"] for r in found], dtype=np.int64)


def _products(vectors: DataFrame, names: str, of: object) -> np.ndarray:
    """Sum over all rows of f f', where ``of`` gives f of a block of rows.

    A task adds up its own rows; the tasks' matrices are added row of the matrix by
    row, in order of the tasks, so that a lost executor changes no digit.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                own = of(_matrix(batch.column(0)))
                total = own.T @ own if total is None else total + own.T @ own
        if total is not None:
            d = len(total)
            part = np.full(d, TaskContext.get().partitionId(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(np.arange(d)), pa.array(list(total))], names=["part", "i", "row"]
            )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        return pd.DataFrame({"i": rows["i"].iloc[:1], "row": [np.sum(np.stack(list(rows["row"])), axis=0)]})

    parts = vectors.select(names).mapInArrow(multiply, "part bigint, i bigint, row array<double>")
    found = parts.groupBy("i").applyInPandas(add, "i bigint, row array<double>").collect()
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["i"])])


# --- eigenpairs of one symmetric matrix ---------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix."""
    a = matrix.copy()
    d = len(a)
    for j in range(d - 2):
        x = a[j + 1 :, j].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x /= size
        a[j + 1 :, j:] -= 2 * np.outer(x, x @ a[j + 1 :, j:])
        a[j:, j + 1 :] -= 2 * np.outer(a[j:, j + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_above(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of T - s I."""
    least = np.finfo(float).tiny
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(int)
    for own, off in zip(diagonal[1:], beside):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = own - shifts - off * off / pivot
        count += pivot > 0
    return count


@dataclass(frozen=True)
class Circle:
    """The eigenvalues between ``low`` and ``high``, ``count`` of them by inertia."""

    low: float
    high: float
    count: int

    def points(self) -> list[tuple[complex, complex]]:
        """(shift, weight) on the upper half circle; the other half is the conjugate."""
        nodes, weights = np.polynomial.legendre.leggauss(POINTS)
        turn = np.exp(1j * np.pi / 2 * (nodes + 1))
        radius = (self.high - self.low) / 2
        return list(zip((self.low + self.high) / 2 + radius * turn, weights / 2 * radius * turn))


def circles(matrix: np.ndarray, leading: int) -> list[Circle]:
    """Circles that hold the ``leading`` largest eigenvalues, and maybe a few more.

    Eigenvalues are placed by inertia counts at bisected shifts and grouped at the
    widest gaps; a circle reaches half of its smaller gap beyond its group, so equal
    eigenvalues are never torn apart, and none lies between two circles.
    """
    diagonal, beside = tridiagonal(matrix)
    d = len(diagonal)
    reach = np.abs(matrix).sum(axis=1).max()
    wanted = np.arange(1, min(leading + BEYOND, d) + 1)
    low, high = np.full(len(wanted), -reach), np.full(len(wanted), reach)
    for _ in range(60):
        middle = (low + high) / 2
        above = counts_above(diagonal, beside, middle) >= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    at = (low + high) / 2
    # gaps[i] lies after the i-th; nothing is known beyond the last but that it is the last.
    gaps = np.append(at[:-1] - at[1:], np.inf if len(at) == d else 0.0)
    groups, start = [], 0
    while start < leading:
        reachable = range(start, min(start + PER_CIRCLE, len(at)))
        end = max(reachable, key=lambda i: (gaps[i], -i))
        if gaps[end] <= EQUAL * reach:  # all equal so far: on to the next real gap
            end = next((i for i in range(start, len(at)) if gaps[i] > EQUAL * reach), None)
            if end is None:  # or as far as the equals go, beyond those that were placed
                return _circles_of_equals(matrix, groups, at, start, reach)
        groups.append((start, end))
        start = end + 1
    return _around(groups, at, gaps, reach, diagonal, beside)


def _circles_of_equals(matrix, groups, at, start, reach) -> list[Circle]:
    """As ``circles``, where more eigenvalues than were placed equal the last."""
    diagonal, beside = tridiagonal(matrix)
    least = at[-1] - EQUAL * reach
    last = int(counts_above(diagonal, beside, np.array([least]))[0])
    low, high = -reach, least
    if last < len(diagonal):  # the next one below them
        for _ in range(60):
            middle = (low + high) / 2
            above = counts_above(diagonal, beside, np.array([middle]))[0] > last
            low, high = (middle, high) if above else (low, middle)
    gap = at[-1] - (low + high) / 2 if last < len(diagonal) else np.inf
    at = np.concatenate([at, np.full(last - len(at), at[-1])])
    gaps = np.append(at[:-1] - at[1:], gap)
    return _around([*groups, (start, last - 1)], at, gaps, reach, diagonal, beside)


def _around(groups, at, gaps, reach, diagonal, beside) -> list[Circle]:
    bounds = []
    for start, end in groups:
        room = min(gaps[end], gaps[start - 1] if start else np.inf)
        if np.isinf(room):
            room = max(at[start] - at[end], reach * 1e-3)
        bounds.append((at[end] - room / 2, at[start] + room / 2))
    low, high = (np.array(x) for x in zip(*bounds))
    counts = counts_above(diagonal, beside, low) - counts_above(diagonal, beside, high)
    if counts.sum() != counts_above(diagonal, beside, low.min(keepdims=True))[0]:
        raise ArithmeticError("an eigenvalue lies between two circles")
    return [Circle(float(a), float(b), int(n)) for a, b, n in zip(low, high, counts)]


def _solve_all(spark, matrix, rings: list[Circle], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The projection of each ring's block: its solves, a task each, added up."""
    shared = spark.sparkContext.broadcast((matrix, [r.points() for r in rings], blocks))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, points, given = shared.value
        for batch in batches:
            for ring, point in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shift, weight = points[ring][point]
                part = np.linalg.solve(shift * np.eye(len(own)) - own, given[ring].astype(complex))
                part = (weight * part).real
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), ring)), pa.array(np.full(len(part), point)),
                        pa.array(np.arange(len(part))), pa.array(list(part)),
                    ],
                    names=["ring", "point", "i", "row"],
                )

    tasks = len(rings) * POINTS
    grid = spark.range(tasks, numPartitions=tasks).select(
        (F.col("id") / POINTS).cast("bigint").alias("ring"), (F.col("id") % POINTS).alias("point")
    )
    found = grid.mapInArrow(solve, "ring bigint, point bigint, i bigint, row array<double>").collect()
    out = [np.zeros(b.shape) for b in blocks]
    for r in sorted(found, key=lambda r: (r["ring"], r["point"], r["i"])):
        out[r["ring"]][r["i"]] += r["row"]
    shared.unpersist()
    return out


def leading_pairs(spark, matrix: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``leading`` largest eigenvalues, falling, and unit eigenvectors as columns.

    The sign of a vector makes its largest entry positive.  Raises where a circle
    does not give as many pairs as the inertia counts, after ``MAX_ROUNDS``.
    """
    d = len(matrix)
    size = np.abs(matrix).sum(axis=1).max()
    rings = circles(matrix, leading)
    random = np.random.default_rng(7)
    blocks = [random.standard_normal((d, min(d, r.count + max(4, r.count // 2)))) for r in rings]
    found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(rings)
    for _ in range(MAX_ROUNDS):
        open_rings = [i for i, f in enumerate(found) if f is None]
        if not open_rings:
            break
        projected = _solve_all(spark, matrix, [rings[i] for i in open_rings], [blocks[i] for i in open_rings])
        for i, block in zip(open_rings, projected):
            basis, _ = np.linalg.qr(block)
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turn
            inside = (values > rings[i].low) & (values < rings[i].high)
            left = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0)
            if inside.sum() == rings[i].count and left <= RESIDUAL * size:
                found[i] = values[inside], vectors[:, inside]
            blocks[i] = vectors
    for ring, pair in zip(rings, found):
        if pair is None:
            raise ArithmeticError(f"{ring.count} eigenvalues between {ring.low} and {ring.high}: not all found")
    # Once more over all circles, so that vectors of close ones are orthogonal too.
    basis, _ = np.linalg.qr(np.concatenate([f[1] for f in found], axis=1))
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1][:leading], (basis @ turn)[:, ::-1][:, :leading]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


# --- over tables ------------------------------------------------------------------


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of ``fixed_point``; None if there are none.

    There are fewer components where the covariance has fewer eigenvalues that are
    not zero: for few or equal vectors, or few or constant entries.
    """
    spark = vectors.sparkSession
    n, sums = _sums(vectors)
    if not n:
        return None
    covariance = _products(vectors, "x", lambda x: _centred(x, sums, n)) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    if trace <= 0:
        return Whitening(n, sums, trace, np.zeros(0), np.zeros((len(sums), 0)))
    diagonal, beside = tridiagonal(covariance)
    real = int(counts_above(diagonal, beside, np.array([ZERO * trace]))[0])
    values, vectors_ = leading_pairs(spark, covariance, min(components, real))
    return Whitening(n, sums, trace, values, vectors_)


def identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(fit.values)
    with_one = _products(vectors, "x", lambda x: np.column_stack([fit.project(x), np.ones(len(x))])) / fit.n
    mean = with_one[:k, k]
    return float(np.abs(with_one[:k, :k] - np.outer(mean, mean) - np.eye(k)).max(initial=0))


RESULT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component.

    Columns: vec_id, component (1 has the largest eigenvalue), n (usable vectors),
    deviation (exact sum over dimensions of (n * x - sum of x)**2; null if no 64-bit
    integer holds it), whitened (the centred vector on the component over the root
    of the eigenvalue), explained (eigenvalue over trace), identity_error (one
    value).  See ``fixed_point`` for the vectors that are left out, and
    ``fit_whitening`` for fewer components; without any there are no rows, so an
    empty table and one of equal vectors give none.  Repeated rows and ids, null
    ids included, have rows of their own; other columns are not read.
    """
    vectors = fixed_point(embeddings, id_col, vec_col)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    fit = fit_whitening(vectors, components)
    if fit is None or len(fit.values) == 0:
        return vectors.sparkSession.createDataFrame([], f"vec_id {id_type}, {RESULT}")
    error = identity_error(vectors, fit)
    k = len(fit.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fit.deviations(x), pa.int64()), pa.array(list(fit.project(x)))],
                names=["vec_id", "deviation", "all"],
            )

    whole = vectors.mapInArrow(rows, f"vec_id {id_type}, deviation bigint, all array<double>")
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    return whole.select("vec_id", "deviation", F.posexplode("all").alias("place", "whitened")).where(
        F.col("place") < k
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(fit.n).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
