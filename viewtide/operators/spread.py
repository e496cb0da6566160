"""Spreading very frequent keys over many tasks while keeping their rows in order.

A window over one video runs in one task. That is right for nearly all videos, but one
video may hold a large share of all observations. Such a video is cut along time into
chunks of bounded size: chunk 0 holds its earliest rows, chunk 1 the next, and so on.
Rows of all other videos keep the single chunk WHOLE. Joins, windows and groupings then
use (key, CHUNK) in place of the key alone, and what must cross a chunk border is carried
over through a table with one row per chunk (see `ordered`).
"""

import logging
from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructType, TimestampNTZType, TimestampType

log = logging.getLogger(__name__)

CHUNK = "_chunk"
WHOLE = -1
FIND = "find"

ROWS_PER_CHUNK = 4_000_000
# Bounds every table this module collects or broadcasts, whatever the size of the data.
MAX_CHUNKS = 100_000

_CUTS = "_cuts"
_LOW, _WIDTH, _LAST = "_low", "_width", "_last"
_SLOT, _BASE, _NEAR = "_slot", "_base", "_near"
_SAMPLED = 400
_FANOUT = 256
_ROUNDS = 4


@dataclass(frozen=True)
class Splits:
    """Ascending cut points of each split key: a table (key, _cuts).

    A row finds its chunk in two steps of equal cost for any number of cuts: its key's
    stretch of time is divided into as many slots as there are cuts (`spans`), and (key,
    slot) leads to the number of cuts before the slot and to the few inside it (`slots`).
    """

    key: str
    order: str
    table: DataFrame
    longest: int
    spans: DataFrame
    slots: DataFrame


def find_splits(
    df: DataFrame,
    key: str = "gid",
    order: str = "updated_at",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_chunks: int = MAX_CHUNKS,
) -> Splits | None:
    """Cut points for the keys with too many rows for one task; None if there are none.

    A table smaller than one chunk costs a row count, for Parquet answered from the
    footers. For a larger one, a thin sample of the key column names the keys that may be
    over the limit, so that the many others are never counted. Only if there are any are
    the rows of those keys read, once or twice per factor of 256. Where the cuts fall
    affects the balance of the work, never a result.
    """
    total = df.count()
    limit = max(rows_per_chunk, -(-total // max_chunks))
    if total <= limit:
        return None
    candidates = _candidates(df, key, limit)
    if candidates.isEmpty():
        return None
    rows = df.select(key, order).join(F.broadcast(candidates), key, "left_semi")
    splits = None
    for _ in range(_ROUNDS):
        pieces = rows.withColumn(CHUNK, F.lit(WHOLE)) if splits is None else spread(rows, splits)
        # At most total / limit <= max_chunks pieces can hold more than `limit` rows.
        oversized = _local(
            pieces.groupBy(key, CHUNK).agg(F.count("*").alias("rows")).filter(F.col("rows") > limit)
        )
        refined = None if oversized.isEmpty() else _refine(pieces, oversized, splits, key, order, limit)
        if refined is None:
            if not oversized.isEmpty():
                log.warning("%d chunks keep more than %d rows, all of one %s", oversized.count(), limit, order)
            break
        splits = refined
    return splits


def found_splits(df: DataFrame, splits: Splits | None | str) -> Splits | None:
    """The splits given, or with FIND those of a frame whose rows are not spread yet."""
    if isinstance(splits, str):
        return None if CHUNK in df.columns else find_splits(df)
    return splits


def spread(df: DataFrame, splits: Splits | None) -> DataFrame:
    """Add CHUNK to rows that carry the splits' key and order columns."""
    if splits is None:
        return df
    place = _place(F.col(splits.order), df.schema[splits.order].dataType)
    slot = F.greatest(F.lit(-1), F.least(F.col(_LAST), F.floor((place - F.col(_LOW)) / F.col(_WIDTH)))).cast("bigint")
    inside = F.size(F.filter(_NEAR, lambda cut: cut <= place))
    # Never NULL, and declared so: otherwise joins on CHUNK test for it by searching again.
    chunk = F.when(F.col(_LOW).isNull(), F.lit(WHOLE)).otherwise(
        F.coalesce((F.col(_BASE) + inside).cast("int"), F.lit(0))
    )
    return (
        df.join(F.broadcast(splits.spans), splits.key, "left")
        .withColumn(_SLOT, slot)
        .join(F.broadcast(splits.slots), [splits.key, _SLOT], "left")
        .select(*[df[c] if c != splits.key else F.col(c) for c in df.columns], chunk.alias(CHUNK))
    )


def replicate(df: DataFrame, splits: Splits | None) -> DataFrame:
    """Repeat the rows of split keys once per chunk, to join with a spread table."""
    if splits is None:
        return df
    chunks = F.when(F.col(_CUTS).isNull(), F.array(F.lit(WHOLE))).otherwise(
        F.sequence(F.lit(0), F.size(_CUTS))
    )
    return (
        df.join(F.broadcast(splits.table), splits.key, "left")
        .withColumn(CHUNK, F.explode(chunks))
        .drop(_CUTS)
    )


def spread_keys(df: DataFrame, *keys: str) -> list[str]:
    """The keys, with CHUNK where the rows are spread."""
    return [*keys, CHUNK] if CHUNK in df.columns else list(keys)


def _place(value: Column, kind: DataType) -> Column:
    """The order column as a whole number: microseconds for times."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, IntegralType):
        return value.cast("bigint")
    raise ValueError(f"rows can be cut along times and whole numbers, not {kind.simpleString()}")


def _with_slots(key: str, order: str, table: DataFrame, kind: DataType) -> Splits:
    """The two lookup tables, of one row per key and one per slot, from the bounded table of cuts."""
    places = table.select(key, F.transform(_CUTS, lambda cut: _place(cut, kind)).alias(_CUTS)).collect()
    spans, slots = [], []
    for found, cuts in places:
        width = max(1, -(-(cuts[-1] - cuts[0] + 1) // len(cuts)))
        last = (cuts[-1] - cuts[0]) // width
        spans.append((found, cuts[0], width, last))
        at = 0
        for slot in range(last + 1):
            end = bisect_left(cuts, cuts[0] + (slot + 1) * width, at)
            slots.append((found, slot, at, cuts[at:end]))
            at = end
    name = f"`{key}` {dict(table.dtypes)[key]}"

    def pinned(rows: list[tuple], columns: str) -> DataFrame:
        schema = StructType.fromDDL(f"{name}, {columns}")
        values = [pa.array(v) for v in zip(*rows)]
        return table.sparkSession.createDataFrame(pa.Table.from_arrays(values, schema.names), schema)

    return Splits(
        key, order, table, max(len(cuts) for _, cuts in places),
        pinned(spans, f"{_LOW} bigint, {_WIDTH} bigint, {_LAST} bigint"),
        pinned(slots, f"{_SLOT} bigint, {_BASE} bigint, {_NEAR} array<bigint>"),
    )


def _candidates(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys that seem to have at least half the limit: at most 2 * max_chunks of them.

    A key at the limit appears _SAMPLED times in the sample, give or take a twentieth.
    """
    share = min(1.0, _SAMPLED / limit)
    keys = df.select(key).filter(F.col(key).isNotNull())
    sample = keys.sample(share, seed=0) if share < 1 else keys
    frequent = sample.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") >= share * limit / 2)
    return _local(frequent.select(key))


def _refine(
    pieces: DataFrame, oversized: DataFrame, splits: Splits | None, key: str, order: str, limit: int
) -> Splits | None:
    """Add cut points inside the oversized pieces, at even shares of their rows.

    None if no piece can be cut, its rows all having the same place in the order.
    """
    shares = [i / _FANOUT for i in range(1, _FANOUT)]
    wanted = F.least(F.lit(_FANOUT), F.ceil(2 * F.col("rows") / limit)).cast("int")
    spaced = F.transform(
        F.sequence(F.lit(1), F.col("wanted") - 1),
        lambda i: F.get("quantiles", F.floor(i * _FANOUT / F.col("wanted")).cast("int") - 1),
    )
    # The highest value is a last resort, for a piece that consists mostly of its lowest.
    cuts = F.filter(F.col("spaced"), lambda cut: cut > F.col("low"))
    found = _local(
        pieces.join(F.broadcast(oversized), [key, CHUNK])
        .groupBy(key, CHUNK, "rows")
        .agg(
            F.percentile_approx(order, shares, 10_000).alias("quantiles"),
            F.min(order).alias("low"),
            F.max(order).alias("high"),
        )
        .filter(F.col("low") < F.col("high"))
        .withColumn("wanted", wanted)
        .withColumn("spaced", spaced)
        .select(key, F.when(F.size(cuts) > 0, cuts).otherwise(F.array("high")).alias(_CUTS))
    )
    if found.isEmpty():
        return None
    if splits is not None:
        found = found.union(splits.table)
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list(_CUTS))))
    table = _local(found.groupBy(key).agg(merged.alias(_CUTS)))
    return _with_slots(key, order, table, pieces.schema[order].dataType)


def _local(bounded: DataFrame) -> DataFrame:
    """Pin a table of bounded size, so that later plans see fixed rows."""
    table: pa.Table = bounded.toArrow()
    return bounded.sparkSession.createDataFrame(table, bounded.schema)
