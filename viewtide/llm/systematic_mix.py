"""Mixing sources to target weights by systematic sampling.

Within a source, documents stand in order of size, then id. Each expects the same number of
copies, its source's target over its size, and these are summed up along the order. With
one random offset added, a document is emitted once per whole number that its stretch of
the running sum passes. As the order is by size, the words taken of a source stay within
about one document of its target, and a document is taken at most three times.

The running sum is rank times expectation, so only ranks have to be known: documents are
counted per source and size, those counts are summed up per source, and rows are numbered
within a source and size only. A size with very many documents (copies of one text) is
first cut into slices of their ids, those without an id into slices of their texts' hashes.
Words are counted once: the rows and their sizes are written and everything reads that.

Defined cases: a missing text has no words. A missing source is a source of its own, the
last one. Documents without an id come last. Repeated rows are rows of their own. Without
any words every target is 0. Columns named like one of the results are replaced by it in
`mix`; `sample` returns the caller's columns as they are. Names that begin with `_mix_` are
reserved.
"""

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.tables import WORD, reserved, store, text_of

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20240607
RESULTS = ("size", "source_size", "target", "copies")
_SLICE_ROWS = 1_000_000
_INNER = "_mix_"


def offset(seed: int = SEED) -> float:
    """The random start in [0, 1), with few enough bits that adding it is exact."""
    return random.Random(seed).getrandbits(20) / (1 << 20)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Every source's size and target."""
    return _plan(docs.select("source", _words().alias("size")), weights, most)


def _words() -> Column:
    return F.regexp_count(text_of("text"), F.lit(WORD)).cast("bigint")


def _plan(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Targets of the sources of (source, size).

    Sources share all words by weight; none gets more than `most` times its own, and what
    is over goes to the others by weight. Stand the sources in order of limit over weight,
    and give each the rate that holds if all before it are at their limits: the first that
    stays below its limit at its rate sets the rate of all from there on. Rates fall from
    it on, as each later one supposes that a source below its limit is at it.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rate = (left / open_weight).cast("double")
    rated = weighed.withColumn("rate", rate).withColumn("below", F.col("rate") * F.col("weight") <= F.col("limit"))
    shared = F.max(F.when(F.col("below"), F.col("rate"))).over(everything)
    limit = F.col("limit").cast("double")
    target = F.coalesce(F.least(limit, F.col("weight") * shared), limit)
    return rated.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    seed: int = SEED,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """The documents with size, source_size, target and their number of copies.

    `columns` names those of the caller's columns that are wanted, by default all.
    """
    own = [c for c in (docs.columns if columns is None else columns) if c not in RESULTS]
    return _mixed(docs, own, seed, weights, most).select(*own, *[F.col(_INNER + c).alias(c) for c in RESULTS])


def sample(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`."""
    mixed = _mixed(docs, docs.columns, seed, WEIGHTS, MOST)
    copy = F.explode(F.array_repeat(F.lit(1), F.col(_INNER + "copies")))
    return mixed.withColumn(_INNER + "copy", copy).select(docs.columns)


def _mixed(docs: DataFrame, own: list[str], seed: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """The columns `own` and the results, under inner names."""
    reserved(docs, _INNER)
    size, none, key, at, ident, tie = (_INNER + c for c in ("size", "no_source", "source", "slice", "id", "tie"))
    rows = store(
        docs.select(
            *own, _words().alias(size), F.col("source").isNull().alias(none),
            F.coalesce("source", F.lit("")).alias(key), F.col("doc_id").alias(ident),
            F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias(tie),
        ), "sized",
    )
    sized = rows.select(F.when(~F.col(none), F.col(key)).alias("source"), F.col(size).alias("size"))
    sources = store(_plan(sized, weights, most), "sources").select(
        F.col("source").isNull().alias(none), F.coalesce("source", F.lit("")).alias(key),
        F.col("source_size").alias(_INNER + "source_size"), F.col("target").alias(_INNER + "target"),
    )
    cell = [none, key, size]
    n, low, high, start = (_INNER + c for c in ("n", "low", "high", "start"))
    counts = rows.groupBy(*cell).agg(F.count("*").alias(n), F.min(ident).alias(low), F.max(ident).alias(high))
    # At most one in `_SLICE_ROWS` of the rows can be such a cell.
    crowded = counts.filter(F.col(n) > _SLICE_ROWS)
    slices = F.ceil(F.col(n) / _SLICE_ROWS)
    width = F.col(high) - F.col(low) + 1
    number = F.coalesce(
        F.floor((F.col(ident) - F.col(low)).cast("double") / width * slices),
        slices + F.pmod(F.col(tie), slices),
    )
    sliced = (
        rows.join(F.broadcast(crowded), cell, "left")
        .withColumn(at, F.when(F.col(n).isNull(), 0).otherwise(number).cast("bigint"))
        .drop(n, low, high)
    )
    cell = [*cell, at]
    before = Window.partitionBy(none, key).orderBy(size, at).rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy(*cell).agg(F.count("*").alias(n)).select(
        *cell, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start)
    )
    starts = starts.join(sources, [none, key])
    within = Window.partitionBy(*cell).orderBy(F.col(ident).asc_nulls_last(), tie)
    source_size, target = F.col(_INNER + "source_size"), F.col(_INNER + "target")
    expected = F.when(source_size > 0, target / source_size).otherwise(0.0)
    expects, rank = _INNER + "expects", _INNER + "rank"
    passed = lambda k: F.floor(k * F.col(expects) + F.lit(offset(seed)))
    return (
        sliced.join(starts, cell)
        .withColumns({expects: expected, rank: F.col(start) + F.row_number().over(within) - 1})
        .withColumn(_INNER + "copies", (passed(F.col(rank) + 1) - passed(F.col(rank))).cast("int"))
    )
