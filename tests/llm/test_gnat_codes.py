import hashlib

import numpy as np
import pytest

from viewtide.llm.gnat_codes import Gnat, compress, encode, fit

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, _of int"


def nearest(points, query):
    squares = [sum((a - b) ** 2 for a, b in zip(p, query)) for p in points.tolist()]
    return min(range(len(squares)), key=lambda k: (squares[k], k)), min(squares)


@pytest.mark.parametrize("kind", ["wide", "few", "equal", "line", "tiny", "large"])
def test_tree_finds_the_nearest_of_lowest_number(kind):
    random = np.random.default_rng(7)
    spread = {"wide": 1000, "few": 3, "equal": 1, "line": 50, "tiny": 40, "large": 1 << 24}[kind]
    points = random.integers(-spread, spread, (5 if kind == "tiny" else 200, 1 if kind == "line" else 4))
    queries = np.concatenate([random.integers(-spread, spread, (300, points.shape[1])), points[:50]])
    number, square = Gnat(points).nearest(queries)
    assert list(zip(number, square)) == [nearest(points, q.tolist()) for q in queries]


def test_tree_leaves_subtrees_out(monkeypatch):
    """Far apart clusters: most distances are never computed."""
    random = np.random.default_rng(1)
    centres = random.integers(-100_000, 100_000, (8, 4))
    points = (centres[:, None] + random.integers(-20, 20, (8, 40, 4))).reshape(-1, 4)
    queries = points + random.integers(-5, 5, points.shape)
    import viewtide.llm.gnat_codes as module
    tree, work, squared = Gnat(points), [], module._squared
    monkeypatch.setattr(module, "_squared", lambda a, b: work.append(len(a) * len(b)) or squared(a, b))
    tree.nearest(queries)
    assert sum(work) < 0.25 * len(points) * len(queries)


def by_hand(rows, parts=16, entries=64, rounds=2):
    """The codes as the rule puts them, one vector at a time."""
    good = [
        (v, [int(np.floor(256 * float(np.float32(x)))) for x in e], label) for v, e, label in rows
        if e is not None and all(x is not None and np.isfinite(x) for x in e)
    ]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(good[0][1]) // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in good]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    for turn in range(rounds + 1):
        found = [[nearest(np.array(books[p]), c[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for j in range(len(books[p])):
                    mine = [c[p] for c, f in zip(cut, found) if f[p][0] == j]
                    if mine:
                        books[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for _, d in f) for f in found]
    sums = {}
    for (_, _, label), error in zip(good, errors):
        sums[label] = sums.get(label, 0) + error
    return sorted((
        (v, "".join(f"{j:02x}" for j, _ in f), e, sums[label], digest)
        for (v, _, label), f, e in zip(good, found, errors)
    ), key=repr)


def test_against_the_rule(spark):
    random = np.random.default_rng(3)
    rows = [(k, random.normal(0, 0.2, 32).round(3).tolist(), k % 3 if k % 5 else None) for k in range(150)]
    rows += [(7, rows[3][1], 1), (7, rows[7][1], 1), (None, rows[9][1], 2), (500, None, 1)]
    rows += [(501, [None, *[0.5] * 31], 1), (502, [float("nan"), *[0.5] * 31], 1), (503, [float("-inf"), *[0.5] * 31], 1)]
    df = spark.createDataFrame([(*r, "c", "e", 4) for r in rows], SCHEMA)
    got = compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)


def test_few_vectors_none_and_faulty_ones(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    few = [(2, [0.1] * 16, None), (1, [0.2] * 16, None)]
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in compress(make(few)).orderBy("vec_id").collect()] == [
        (1, "00" * 16, 0, 0), (2, "01" * 16, 0, 0)]
    assert compress(make([])).collect() == [] and compress(make([(1, None, 1)])).collect() == []
    with pytest.raises(ValueError, match="17 components"):
        fit(make([(1, [0.5] * 17, 1)]))
    books = fit(make([(1, [0.5] * 16, 1)]))
    for bad, message in (([0.5] * 32, "different lengths"), ([1e9] * 16, "components of")):
        with pytest.raises(Exception, match=message):
            encode(make([(1, bad, 1)]), books).collect()
