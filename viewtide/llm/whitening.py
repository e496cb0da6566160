"""Whitening of embeddings by the leading eigenvectors of their covariance.

Tasks add up the distinct vectors, then the products of their deviations from the mean;
what reaches the driver is one matrix of the vectors' dimensions, whatever their number.
There it is brought into tridiagonal form by Householder reflections, the leading
eigenvalues are found by bisection on Sturm counts, and the eigenvectors by inverse
iteration, in which those of eigenvalues close together are kept orthogonal to each other.
The projection is sent back to the tasks with the rows.

Components are whole numbers, floor(64 * c) + 1,000,000, so sums and deviations are exact:
a deviation from the mean is (n * x - S) / n with a whole numerator.

Defined cases: rows whose vector is missing or holds a missing or non-finite component are
left out. Repeated vectors count once in the fit, and each of their rows has its result. A
component without variance can't be whitened and is left out, so a single distinct vector
has no rows. `deviation` is missing where it passes a long. Vectors must have one length
and components below 2**20, else a ValueError says so. An empty table gives no rows. Other
columns are not looked at.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import store
from viewtide.llm.vectors import kept, whole

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
_EPS = np.finfo(float).eps
_CELL = "cell int, total double"


@dataclass
class Whitening:
    """Of the fit list: its number, its sums, its leading components as columns."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, whole."""
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x) / self.n @ self.vectors / np.sqrt(self.values)


def distinct(vectors: DataFrame) -> DataFrame:
    """Every vector of whole numbers once, as the bytes of its components."""
    return kept(vectors).mapInArrow(_keys, "x binary").distinct()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening and the written fit list."""
    fit_list = store(distinct(vectors), "fit-list")
    totals = fit_list.mapInArrow(_sums, "place int, total bigint, n bigint").groupBy("place").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    ).orderBy("place").toArrow()
    sums = totals.column("total").to_numpy()
    if not len(sums):
        none = np.zeros((0, 0))
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0), none, 0.0), fit_list
    n = totals.column("n")[0].as_py()
    if n * (SHIFT + (1 << 26)) >= 1 << 62:
        raise ValueError("too many distinct vectors for exact deviations")
    start = Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    covariance = _products(fit_list, lambda x: start.deviations(x) / n, len(sums)) / n
    values, basis = leading(covariance, min(components, len(sums)))
    trace = float(np.trace(covariance))
    real = values > len(sums) * _EPS * trace
    return Whitening(n, sums, values[real], basis[:, real], trace), fit_list


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model, fit_list = fit(vectors, components)
    size = len(model.values)
    error = np.abs(_products(fit_list, model.whitened, size) / model.n - np.eye(size)).max() if size else 0.0
    return kept(vectors, "vec_id").mapInArrow(
        lambda batches: _rows(batches, model),
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double",
    ).withColumn("identity_error", F.lit(float(error)))


def _shifted(batch: pa.RecordBatch) -> np.ndarray:
    return whole(batch, SCALE) + SHIFT


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_pydict({"x": pa.array([row.tobytes() for row in _shifted(batch)], pa.binary())})


def _listed(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch of the fit list."""
    rows = batch.column("x").to_pylist()
    if len({len(row) for row in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            x = _listed(batch)
            total = x.sum(0) if total is None else total + x.sum(0)
            n += len(x)
    if n:
        yield pa.RecordBatch.from_pydict({
            "place": np.arange(len(total), dtype=np.int32), "total": total, "n": np.full(len(total), n),
        })


def _products(fit_list: DataFrame, values, size: int) -> np.ndarray:
    """The sum over the fit list of the outer products of `values(x)`."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = values(_listed(batch))
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"cell": np.arange(size * size, dtype=np.int32), "total": total.reshape(-1)})

    cells = fit_list.mapInArrow(add, _CELL).groupBy("cell").agg(F.sum("total").alias("total")).orderBy("cell")
    total = cells.toArrow().column("total").to_numpy().reshape(size, size)
    return (total + total.T) / 2


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    size = len(model.values)
    for batch in batches:
        if not batch.num_rows or not size:
            continue
        x = _shifted(batch)
        vec_id = batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), size)))
        yield pa.RecordBatch.from_pydict({
            "vec_id": vec_id.cast(pa.int64()),
            "component": np.tile(np.arange(1, size + 1, dtype=np.int32), len(x)),
            "n": np.full(len(x) * size, model.n),
            "deviation": _squares(model.deviations(x)).take(pa.array(np.repeat(np.arange(len(x)), size))),
            "whitened": model.whitened(x).reshape(-1),
            "explained": np.tile(model.values / model.trace, len(x)),
        })


def _squares(deviations: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row, missing where it passes a long."""
    if np.square(deviations.astype(float)).sum(1).max() < 2.0**62:
        return pa.array((deviations * deviations).sum(1))
    totals = [sum(v * v for v in row) for row in deviations.tolist()]
    return pa.array([t if t < 1 << 63 else None for t in totals], pa.int64())


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    diagonal, beside, reflections = _tridiagonal(matrix)
    values = _bisect(diagonal, beside, k)
    vectors = _inverse_iteration(diagonal, beside, values)
    for at, u in reversed(reflections):
        vectors[at:] -= 2 * np.outer(u, u @ vectors[at:])
    return values, vectors / np.linalg.norm(vectors, axis=0)


def _tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections with their first place."""
    a = matrix.astype(float).copy()
    reflections = []
    for k in range(len(a) - 2):
        u = a[k + 1 :, k].copy()
        length = np.linalg.norm(u)
        if length == 0 or not u[1:].any():
            continue
        u[0] += np.copysign(length, u[0])
        u /= np.linalg.norm(u)
        a[k + 1 :, k:] -= 2 * np.outer(u, u @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
        reflections.append((k + 1, u))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def _below(diagonal: np.ndarray, squares: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each x."""
    pivot = diagonal[0] - x
    count = (pivot < 0).astype(int)
    for d, square in zip(diagonal[1:], squares):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - x - square / pivot
        count += pivot < 0
    return count


def _bisect(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of a tridiagonal matrix, each to the last bits."""
    size = len(diagonal)
    around = np.concatenate([[0], np.abs(beside)]) + np.concatenate([np.abs(beside), [0]])
    norm = max(np.abs(diagonal).max() + around.max(), np.finfo(float).tiny)
    low, high = np.full(k, (diagonal - around).min() - _EPS * norm), np.full(k, (diagonal + around).max() + 4 * _EPS * norm)
    wanted = size - 1 - np.arange(k)
    squares, least = beside * beside, max(np.finfo(float).tiny / _EPS, _EPS * _EPS * norm)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= _EPS * np.abs(middle) / 2)).all():
            return middle
        above = _below(diagonal, squares, middle, least) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns. Within a cluster of eigenvalues, less than a thousandth
    of the norm apart, each is kept orthogonal to those before it."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0), np.finfo(float).tiny)
    random = np.random.default_rng(0)
    vectors = np.zeros((size, len(values)))
    cluster, last = 0, None
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster = k
        # Equal eigenvalues a little apart, so that the systems differ.
        at = value if last is None or last - value > 2 * _EPS * norm else last - 2 * _EPS * norm
        last = at
        solve = _factored(diagonal - at, beside, max(_EPS * norm, 1e-150))
        v = random.uniform(0.5, 1, size)
        for _ in range(6):
            v = solve(v)
            v /= np.abs(v).max()
            for _ in range(2):
                v -= vectors[:, cluster:k] @ (vectors[:, cluster:k].T @ v)
            length = np.linalg.norm(v)
            v = v / length if length > 1e-3 / size else random.uniform(-1, 1, size)
        for _ in range(2):
            v -= vectors[:, cluster:k] @ (vectors[:, cluster:k].T @ v)
        vectors[:, k] = v / np.linalg.norm(v)
    return vectors


def _factored(diagonal: np.ndarray, beside: np.ndarray, least: float):
    """Solver of a tridiagonal system, by elimination with row exchanges."""
    size = len(diagonal)
    d, e = diagonal.tolist(), beside.tolist()
    rows, steps = [], []
    pivot, right, far = d[0], e[0] if size > 1 else 0.0, 0.0
    for i in range(size - 1):
        below, mid, next_ = e[i], d[i + 1], e[i + 1] if i + 2 < size else 0.0
        if abs(below) > abs(pivot):
            factor = pivot / below
            rows.append((below, mid, next_))
            steps.append((True, factor))
            pivot, right, far = right - factor * mid, far - factor * next_, 0.0
        else:
            pivot = pivot if abs(pivot) > least else least
            factor = below / pivot
            rows.append((pivot, right, far))
            steps.append((False, factor))
            pivot, right, far = mid - factor * right, next_ - factor * far, 0.0
    rows.append((pivot if abs(pivot) > least else least, 0.0, 0.0))

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for i, (exchanged, factor) in enumerate(steps):
            if exchanged:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor * y[i]
        x = [0.0] * (size + 2)
        for i in range(size - 1, -1, -1):
            p, r, f = rows[i]
            x[i] = (y[i] - r * x[i + 1] - f * x[i + 2]) / p
        return np.array(x[:size])

    return solve
