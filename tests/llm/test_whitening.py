from fractions import Fraction

import numpy as np
import pytest

from viewtide.llm.whitening import leading, whiten

random = np.random.default_rng(1)


def turned(values):
    size = len(values)
    q = np.linalg.qr(random.normal(size=(size, size)))[0]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("matrix", [
    turned(random.uniform(0, 5, 64)), turned([1.0] * 20 + [0.0] * 44), turned(10.0 ** -np.arange(30)),
    turned(1 + 1e-12 * np.arange(25)), np.eye(20), np.zeros((6, 6)), np.array([[3.0]]), np.array([[2.0, 1], [1, 2]]),
    np.kron(np.eye(6), [[2.0, 1], [1, 2]]), np.ones((9, 9)),
])
def test_eigenvalues_and_vectors(matrix):
    matrix = (matrix + matrix.T) / 2
    k, norm = min(16, len(matrix)), max(np.abs(matrix).max(), 1)
    values, vectors = leading(matrix, k)
    assert values == pytest.approx(np.linalg.eigvalsh(matrix)[::-1][:k], abs=1e-13 * norm)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * norm


def make(spark, rows):
    return spark.createDataFrame(
        [(*r, "n", 2.0, 3) for r in rows], "vec_id long, embedding array<double>, label int, n string, whitened double, x int"
    )


def by_hand(rows, components=16):
    good = [(v, [int(np.floor(64 * x)) + 1_000_000 for x in e]) for v, e, _ in rows
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    result = {}
    for v, x in good:
        y = [n * a - s for a, s in zip(x, sums)]
        result.setdefault(v, (n, sum(a * a for a in y), np.array(y) / n @ vectors / np.sqrt(values)))
    return result, values / np.trace(covariance)


@pytest.mark.parametrize("size", [20, 3])
def test_against_the_rule(spark, size):
    scales = np.linspace(3, 0.4, size)
    rows = [(k, (random.normal(0, 1, size) * scales).tolist(), 1) for k in range(400)]
    rows += [(500 + k, rows[k][1], None) for k in range(60)] + [(600, None, 1), (601, [float("nan")] * size, 1)]
    rows += [(602, [None] + [1.0] * (size - 1), 1), (603, [float("inf")] * size, 1), (None, rows[0][1], 1)]
    expected, explained = by_hand(rows)
    got = {}
    for r in whiten(make(spark, rows)).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    k = min(16, size)
    assert got.keys() == expected.keys() and all(sorted(c) == list(range(1, k + 1)) for c in got.values())
    signs = None
    for v, (n, deviation, whitened) in expected.items():
        ours = np.array([got[v][c].whitened for c in range(1, k + 1)])
        signs = np.sign(ours * whitened) if signs is None else signs
        assert ours == pytest.approx(signs * whitened, abs=1e-9)
        assert {(r.n, r.deviation) for r in got[v].values()} == {(n, deviation)}
        assert [got[v][c].explained for c in range(1, k + 1)] == pytest.approx(explained, rel=1e-10)
        assert all(r.identity_error < 1e-12 for r in got[v].values())


def test_cases(spark):
    assert whiten(make(spark, [])).collect() == [] and whiten(make(spark, [(1, None, 1)])).collect() == []
    assert whiten(make(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).collect() == []
    # All variance along one line: one component.
    got = whiten(make(spark, [(k, [k / 64, 2 * k / 64, 5.0], 1) for k in range(9)])).collect()
    assert {r.component for r in got} == {1} and len(got) == 9
    assert sum(r.whitened ** 2 for r in got) / 9 == pytest.approx(1) and got[0].explained == pytest.approx(1)
    with pytest.raises(Exception, match="different lengths"):
        whiten(make(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)])).collect()


def test_deviations_beyond_a_long(spark):
    rows = [(k, [900_000.0 * (-1) ** k, float(k)], 1) for k in range(600)]
    got = {r.vec_id: r.deviation for r in whiten(make(spark, rows)).collect()}
    expected, _ = by_hand(rows)
    assert got == {v: d if d < 1 << 63 else None for v, (_, d, _) in expected.items()}
    assert None in got.values()


def test_on_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    expected, explained = by_hand([(r.vec_id, r.embedding, 0) for r in df.collect()])
    rows = whiten(df).collect()
    assert len(rows) == 16 * df.count()
    for r in rows:
        n, deviation, whitened = expected[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(abs(whitened[r.component - 1]), abs=1e-8)
