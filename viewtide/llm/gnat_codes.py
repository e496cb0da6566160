"""Vector codes by codebook, their nearest entries found in a GNAT.

Vectors are cut into equal parts and every part is replaced by the number of the nearest
entry of its position's codebook. The entries of a codebook stand in a geometric
near-neighbour access tree: a node holds a few split points and, for every split point and
every child, the least and the greatest distance from the one to the members of the other.
A query measures its distance to the split points, and a child none of whose members can
be as near as the best entry found so far is left out as a whole. Distances in these
bounds are rounded outwards and the comparison is strict, so no entry at the same distance
is lost; what remains is compared by whole squared distances, ties to the lower number.

Codebooks start as the parts of the vectors with the smallest ids. A round assigns every
part and replaces each entry by the rounded-down mean of its parts: tasks send one sum per
entry and component, and the driver holds one codebook, whose size does not depend on the
number of vectors.

Defined cases: rows whose vector is missing or holds a missing or non-finite component are
left out. With fewer vectors than entries the codebooks are that much smaller. Rows
without an id come last among the starting vectors, equal ids in the order of their
vectors. Repeated rows are rows of their own. A missing label is a label. Vectors must
have one length, a multiple of the number of parts, and components below 2**18, else a
ValueError says so. An empty table gives no rows. Other columns are not looked at.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import store
from viewtide.llm.vectors import kept, whole

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
_DEGREE = 6
_LEAF = 8
_OUTWARD = 2.0**-50


@dataclass
class _Node:
    """Entries by number, ascending: split points if there are children, else a leaf.

    `low[i, j]` and `high[i, j]` bound the distance from split point i to the members of child j.
    """

    numbers: np.ndarray
    children: list["_Node | None"]
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    """Nearest of some points of whole numbers."""

    def __init__(self, points: np.ndarray, degree: int = _DEGREE, leaf: int = _LEAF):
        self.points, self.degree, self.leaf = points, degree, leaf
        self.root = self._build(np.arange(len(points)))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest point of each query, the lower of equally near, and squared distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        number = np.full(len(queries), len(self.points))
        self._search(self.root, queries, np.arange(len(queries)), best, number)
        return number, best

    def _build(self, numbers: np.ndarray) -> _Node:
        if len(numbers) <= max(self.leaf, self.degree):
            return _Node(numbers, [])
        # Split points far apart: each is the farthest from those before it.
        splits = [0]
        away = _squared(self.points[numbers], self.points[numbers[:1]])[:, 0]
        while len(splits) < self.degree and away.max() > 0:
            splits.append(int(away.argmax()))
            away = np.minimum(away, _squared(self.points[numbers], self.points[numbers[splits[-1:]]])[:, 0])
        if len(splits) == 1:
            return _Node(numbers, [])
        splits = np.sort(np.array(splits))
        chosen, rest = numbers[splits], np.delete(numbers, splits)
        squares = _squared(self.points[rest], self.points[chosen])
        home = squares.argmin(1)
        low, high = np.zeros((2, len(chosen), len(chosen)))
        children: list[_Node | None] = []
        for j in range(len(chosen)):
            members = home == j
            children.append(self._build(rest[members]) if members.any() else None)
            if members.any():
                distance = np.sqrt(squares[members].astype(float))
                low[:, j] = distance.min(0) * (1 - _OUTWARD)
                high[:, j] = distance.max(0) * (1 + _OUTWARD)
        return _Node(chosen, children, low, high)

    def _search(self, node: _Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
        squares = _squared(queries[rows], self.points[node.numbers])
        home = squares.argmin(1)
        found, which = squares[np.arange(len(rows)), home], node.numbers[home]
        closer = (found < best[rows]) | ((found == best[rows]) & (which < number[rows]))
        best[rows[closer]], number[rows[closer]] = found[closer], which[closer]
        distance = np.sqrt(squares.astype(float)) if node.children else None
        # The child of the nearest split point first: it shortens the reach for the others.
        for own in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                at = np.flatnonzero((home == j) == own)
                reach = (np.sqrt(best[rows[at]].astype(float)) * (1 + _OUTWARD))[:, None]
                beyond = (distance[at] * (1 - _OUTWARD) - node.high[:, j] > reach) | (
                    node.low[:, j] - distance[at] * (1 + _OUTWARD) > reach
                )
                at = at[~beyond.any(1)]
                if len(at):
                    self._search(child, queries, rows[at], best, number)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `a` and `b`, summed component by component."""
    total = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        step = a[:, k, None] - b[None, :, k]
        total += step * step
    return total


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of whole numbers: part, entry, place within the part."""
    rows = kept(vectors, "vec_id")
    # One row per entry.
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    start = whole(first.combine_chunks().to_batches()[0], SCALE) if len(first) else np.zeros((0, parts), np.int64)
    if start.shape[1] % parts:
        raise ValueError(f"vectors of {start.shape[1]} components can't be cut into {parts} equal parts")
    codebooks = start.reshape(len(start), parts, start.shape[1] // parts).transpose(1, 0, 2)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = _moved(rows, codebooks)
    return codebooks


def _moved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Entries replaced by the means of their parts; those without parts stay."""
    places = rows.select("embedding").mapInArrow(
        lambda batches: _sums(batches, codebooks), "place int, total bigint, n bigint"
    )
    # One row per entry and component.
    sums = places.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
    place, total, n = (sums.column(c).to_numpy() for c in ("place", "total", "n"))
    moved = codebooks.reshape(-1).copy()
    moved[place] = total // n
    return moved.reshape(codebooks.shape)


def encode(vectors: DataFrame, codebooks: np.ndarray, columns: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """The rows' `columns`, their code in hex and the squared distance to the vector it stands for."""
    types = dict(vectors.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", code string, error bigint"
    return kept(vectors, *columns).mapInArrow(lambda batches: _codes(batches, codebooks, columns), schema)


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code, error, the label's summed error and a digest of the codebooks."""
    codebooks = fit(vectors)
    coded = store(encode(vectors, codebooks), "codes")
    by_label = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()
    return (
        coded.join(by_label, F.col("label").eqNullSafe(F.col("_of")))
        .drop("_of").withColumn("codebooks_sha256", F.lit(digest))
    )


def _assigned(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray):
    """Per batch: the batch, its parts as (part, row, place), and numbers and squared distances by part."""
    trees = [Gnat(entries) for entries in codebooks]
    for batch in batches:
        if batch.num_rows:
            queries = whole(batch, SCALE)
            if queries.shape[1] != codebooks.shape[0] * codebooks.shape[2]:
                raise ValueError("vectors of different lengths")
            queries = queries.reshape(batch.num_rows, len(codebooks), -1).transpose(1, 0, 2)
            yield batch, queries, [tree.nearest(part) for tree, part in zip(trees, queries)]


def _sums(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    totals, counts = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
    for _, queries, found in _assigned(batches, codebooks):
        for part, (number, _) in enumerate(found):
            np.add.at(totals[part], number, queries[part])
            counts[part] += np.bincount(number, minlength=codebooks.shape[1])
    places = np.repeat(counts.reshape(-1), codebooks.shape[2])
    used = np.flatnonzero(places)
    yield pa.RecordBatch.from_pydict({
        "place": used.astype(np.int32), "total": totals.reshape(-1)[used], "n": places[used],
    })


def _codes(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray, columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch, _, found in _assigned(batches, codebooks):
        numbers = np.stack([number for number, _ in found], 1).astype(np.uint8)
        digits = numbers.tobytes().hex()
        width = 2 * numbers.shape[1]
        yield pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in columns},
            "code": [digits[k : k + width] for k in range(0, len(digits), width)],
            "error": np.sum([square for _, square in found], 0),
        })
