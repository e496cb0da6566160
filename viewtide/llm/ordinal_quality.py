"""Quality by ordinal regression on graded ratings.

Grades are ordered: 0 toxic, 1 poor, 2 good. One weight per hashed feature gives a document
a single score s, shared by all grades, and ordered thresholds t give the chance of each
grade: P(grade > k) = 1 / (1 + exp(t_k - s)). From these come the expected grade and the
tail probability of the best grade, by which documents are kept.

Features are the presence of each word (lower case, without punctuation) in one of 2^18
buckets, and the level of a few shares of the text: capitals, symbols, digits, repeated
words, marks of lists. They are made where the documents are; the model is fitted on a
bounded sample of rated documents and is of a fixed size. The sample are the documents whose
ids hash lowest: as many as have `most_features` features together, `most_rated` at most,
however often an id is repeated. Scoring is one pass without a shuffle.

Defined cases: a missing text is scored as an empty one. Ratings with a missing quality or
without a document are not learned from; a missing `toxic` counts as 0. Without any usable
rating every document is kept, with missing scores. `score` puts its columns in place of
those the caller has under the same names; `kept` returns the caller's columns as they were.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import reserved, store, text_of
from viewtide.llm.words import BREAKS, pieces, split

BUCKETS = 1 << 18
MOST_RATED = 12_000
MOST_FEATURES = 20_000_000
KEEP_FROM = 0.5
_ADDED = {"expected_grade": "double", "tail_1": "double", "tail_2": "double", "keep": "boolean"}
_PREFIX = "_quality_"
_LEVELS = 12
_SHARES = 5
_STEPS = 200
_LEAST_DOCUMENTS = 3


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k."""
        return _logistic(score[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each pair once."""
    rows = len(offsets) - 1
    words = split(data, offsets, BREAKS)
    bucket = (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
    pairs = np.unique(words.document * (BUCKETS + 1) + bucket)
    row, feature = pairs // (BUCKETS + 1), pairs % (BUCKETS + 1)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    n_bytes = np.maximum(1, np.bincount(owner, minlength=rows))
    count = lambda flags: np.bincount(owner[flags], minlength=rows)
    n_words = np.maximum(1, np.bincount(words.document, minlength=rows))
    again = np.zeros(len(words.hashes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.document[1:] == words.document[:-1])
    symbol = BREAKS[data] & (data > 32)
    shares = [
        count((data >= 65) & (data <= 90)) / n_bytes,
        count(symbol) / n_bytes,
        count((data >= 48) & (data <= 57)) / n_bytes,
        np.bincount(words.document[again], minlength=rows) / n_words,
        np.minimum(1, count(data == 124) / n_words),
    ]
    # A share at level l has all levels up to l.
    for k, share in enumerate(shares):
        level = np.clip(np.ceil(np.log2(np.maximum(share, 1e-9)) + _LEVELS - 1), 0, _LEVELS - 1).astype(np.int64)
        for at_least in range(1, _LEVELS):
            reached = np.flatnonzero(level >= at_least)
            row = np.concatenate([row, reached])
            feature = np.concatenate([feature, np.full(len(reached), BUCKETS + k * _LEVELS + at_least)])
    return row, feature


def fit(
    docs: DataFrame, labels: DataFrame, most_rated: int = MOST_RATED, most_features: int = MOST_FEATURES
) -> Model | None:
    """Learn from at most `most_rated` rated documents with `most_features` features in all."""
    graded = labels.filter("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("rated_id"),
        F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1).alias("grade"),
    )
    # At most `most_rated` rows of two numbers.
    chosen = graded.orderBy(F.xxhash64("rated_id"), "rated_id", "grade").limit(most_rated)
    rated = docs.select(F.col("doc_id"), text_of("text").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")
    ).select("rated_id", "grade", "text")
    # An id may be that of many documents, and a document may be very long.
    examples = store(rated.mapInArrow(_example, "rated_id bigint, grade int, size int, features binary"), "examples")
    order = [F.xxhash64("rated_id"), F.col("rated_id"), F.col("grade"), F.col("size"), F.xxhash64("features")]
    sizes = examples.orderBy(*order).limit(most_rated).select("size").toArrow().column("size").to_numpy()
    fetched = max(1, int(np.searchsorted(np.cumsum(sizes.astype(np.int64)), most_features, "right")))
    table = examples.orderBy(*order).limit(fetched).select("grade", "features").toArrow()
    grades = table.column("grade").to_numpy().astype(np.int64)
    if not len(grades):
        return None
    lists = [np.frombuffer(x, np.int32) for x in table.column("features").to_pylist()]
    # The same rows in the same order, whichever task came first.
    order = sorted(range(len(lists)), key=lambda k: (grades[k], lists[k].tobytes()))
    lists, grades = [lists[k] for k in order], grades[order]
    row = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    return _descend(row, np.concatenate(lists), grades)


def _descend(row: np.ndarray, feature: np.ndarray, grades: np.ndarray, levels: int = 3) -> Model:
    """Maximum likelihood with a small ridge, by Adam over all examples."""
    size, n = BUCKETS + _SHARES * _LEVELS, len(grades)
    often = np.bincount(feature, minlength=size) >= _LEAST_DOCUMENTS
    row, feature = row[often[feature]], feature[often[feature]]
    known, column = np.unique(feature, return_inverse=True)
    share = np.array([(grades > k).mean() for k in range(levels - 1)]).clip(0.01, 0.99)
    first = -np.log(share / (1 - share))
    # Thresholds as a first one and positive steps, so that their order holds.
    at = np.concatenate([np.zeros(len(known)), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    mean, square = np.zeros_like(at), np.zeros_like(at)
    bound = np.arange(levels - 1)
    for step in range(1, _STEPS + 1):
        weights, cut = at[: len(known)], at[len(known) :]
        thresholds = cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))])
        score = np.bincount(row, weights[column], minlength=n)
        tail = _logistic(score[:, None] - thresholds[None, :])
        chain = np.hstack([np.ones((n, 1)), tail, np.zeros((n, 1))])
        chance = np.maximum(chain[np.arange(n), grades] - chain[np.arange(n), grades + 1], 1e-9)
        slope = tail * (1 - tail)
        by_threshold = slope * ((grades[:, None] == bound + 1) * 1.0 - (grades[:, None] == bound)) / chance[:, None]
        by_score = -by_threshold.sum(1)
        to_cut = by_threshold.sum(0)
        gradient = np.concatenate([
            np.bincount(column, by_score[row], minlength=len(known)) + 2e-1 * weights,
            [to_cut.sum()], np.exp(cut[1:]) * np.cumsum(to_cut[::-1])[::-1][1:],
        ])
        gradient /= n
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        at = at - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[known] = at[: len(known)]
    cut = at[len(known) :]
    return Model(weights, cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))]))


def _example(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            row, feature = features(data, offsets)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, part.num_rows))
            lists = [x.astype(np.int32).tobytes() for x in np.split(feature[order], cuts)]
            yield pa.RecordBatch.from_pydict({
                "rated_id": part.column("rated_id").cast(pa.int64()), "grade": part.column("grade"),
                "size": pa.array([len(x) // 4 for x in lists], pa.int32()), "features": pa.array(lists, pa.binary()),
            })


def score(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns of the documents, then expected_grade, tail_1, tail_2 and keep."""
    scored = _scored(docs, model, keep_from)
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in _ADDED]
    return scored.select(*own, *[F.col(_PREFIX + c).alias(c) for c in _ADDED])


def kept(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents whose best grade is likely, with their own columns."""
    return _scored(docs, model, keep_from).filter(_PREFIX + "keep").select(*[F.col(f"`{c}`") for c in docs.columns])


def _scored(docs: DataFrame, model: Model | None, keep_from: float) -> DataFrame:
    """All columns of the documents, then the added ones under reserved names."""
    reserved(docs, _PREFIX)
    if model is None:
        unknown = {n: F.lit(True) if t == "boolean" else F.lit(None).cast(t) for n, t in _ADDED.items()}
        return docs.select("*", *[value.alias(_PREFIX + name) for name, value in unknown.items()])
    ahead = docs.withColumn(_PREFIX + "text", text_of("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    added = [f"{_PREFIX}{name} {kind}" for name, kind in _ADDED.items()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, data, offsets in pieces(batch, _PREFIX + "text"):
                row, feature = features(data, offsets)
                known = shared.value
                tails = known.tails(np.bincount(row, known.weights[feature].astype(np.float64), minlength=part.num_rows))
                own = part.select([n for n in part.schema.names if n != _PREFIX + "text"])
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(tails.sum(1)), pa.array(tails[:, 0]), pa.array(tails[:, 1]),
                     pa.array(tails[:, 1] >= keep_from)],
                    names=[*own.schema.names, *[_PREFIX + name for name in _ADDED]],
                )

    return ahead.mapInArrow(run, ", ".join(fields + added))
