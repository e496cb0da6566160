"""Exact deduplication by sorting contents.

Sampled splitters (those of `repartitionByRange`) deal the documents over ranges of their
normalised text, each range is sorted on disk if need be, equal texts become neighbours,
and each row is compared in full with the one before it. Of a run of equal texts the first
row stays.

The order is: the first bytes of the normalised text, its SHA-256, more code points in
the original first, smaller id first. The splitters are cut from those keys only, so that
what the driver samples is bounded by the number of ranges whatever the length of the
texts; and as the id is part of the order, a run of any size spans as many ranges as its
rows need. A run that continues in the next range is recognised there by its digest: per
range at most the first and the last run are looked at again.

Defined cases: a missing text equals the empty one, and texts of white space only are equal
to it as well. Without an id a row comes after those of its length that have one. Repeated
rows count one by one; the first of them stays. Other columns are not read.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import SPACE, store, text_of

PREFIX_BYTES = 32

_SCHEMA = "doc_id bigint, digest binary, head_id bigint, head boolean, run_rows bigint, range_id int, edge boolean"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("digest", pa.binary()), ("head_id", pa.int64()), ("head", pa.bool_()),
    ("run_rows", pa.int64()), ("range_id", pa.int32()), ("edge", pa.bool_()),
])


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = text_of(text_column)
    normal = F.regexp_replace(text, SPACE, "")
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.length(text).alias("points"),
        normal.cast("binary").alias("content"),
    ).withColumns({
        "lead": F.substring("content", 1, PREFIX_BYTES),
        "digest": F.unhex(F.sha2("content", 256)),
    })
    order = [F.col("lead"), F.col("digest"), F.col("points").desc(), F.col("doc_id").asc_nulls_last()]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = store(
        ranges.select("doc_id", "content", "digest", F.spark_partition_id().alias("range_id"))
        .mapInArrow(_runs, _SCHEMA),
        "runs",
    )
    # Two runs of each range at most; together those of a digest are one run.
    edges = (
        found.filter("edge and head")
        .groupBy("digest")
        .agg(F.min_by("head_id", "range_id").alias("first_id"), F.min("range_id").alias("first_range"),
             F.sum("run_rows").alias("all_rows"))
    )
    joined = found.join(F.broadcast(edges), "digest", "left")
    in_first = F.col("first_range").isNull() | (F.col("first_range") == F.col("range_id"))
    return joined.select(
        "doc_id",
        F.when(F.col("first_range").isNull(), F.col("head_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("all_rows", "run_rows").alias("group_size"),
        (F.col("head") & in_first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of equal neighbours of one range. Of the open run only the ids are held."""
    content, digest, ids, range_id = None, None, [], 0
    first, pending = True, []

    def close(last: bool):
        nonlocal first
        edge = first or last
        first = False
        return ids, digest, range_id, edge

    for batch in batches:
        columns = [batch.column(name) for name in ("doc_id", "content", "digest", "range_id")]
        for doc_id, value, key, part in zip(columns[0].to_pylist(), columns[1], columns[2], columns[3]):
            buffer = value.as_buffer()
            if content is not None and buffer.equals(content):
                ids.append(doc_id)
                continue
            if content is not None:
                pending.append(close(False))
            content, digest, ids, range_id = pa.py_buffer(buffer.to_pybytes()), key.as_py(), [doc_id], part.as_py()
        # The last run is still open here, so no pending one is the last of the range.
        if pending:
            yield _batch(pending)
            pending = []
    if content is not None:
        yield _batch([close(True)])


def _batch(runs: list) -> pa.RecordBatch:
    ids, digests, heads, firsts, sizes, ranges, edges = [], [], [], [], [], [], []
    for members, digest, range_id, edge in runs:
        n = len(members)
        ids += members
        digests += [digest] * n
        heads += [members[0]] * n
        firsts += [True] + [False] * (n - 1)
        sizes += [n] * n
        ranges += [range_id] * n
        edges += [edge] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip((ids, digests, heads, firsts, sizes, ranges, edges), _ARROW)],
        schema=_ARROW,
    )
