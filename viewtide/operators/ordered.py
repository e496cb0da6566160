"""Previous values and running totals per key, along an order column.

Without CHUNK these are plain windows. With it, each chunk is a window of its own and
receives what precedes it from a carry table that has one row per chunk of a split key:
built by partial aggregation, bounded by the number of chunks, and so safe to broadcast.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.operators.spread import CHUNK, WHOLE, spread_keys


def with_previous(
    df: DataFrame, columns: tuple[str, ...], keys: tuple[str, ...], order: str
) -> tuple[DataFrame, dict[str, Column]]:
    """The frame and, per column, an expression for its value in the key's previous row."""
    window = Window.partitionBy(*spread_keys(df, *keys)).orderBy(order)
    if CHUNK not in df.columns:
        return df, {c: F.lag(c).over(window) for c in columns}
    ends = _per_chunk(df, keys, [F.max_by(c, order).alias(c) for c in columns])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = ends.select(*keys, CHUNK, *[F.lag(c).over(earlier).alias(_carry(c)) for c in columns])
    lagged = df.select(
        "*",
        F.row_number().over(window).alias("_position"),
        *[F.lag(c).over(window).alias(_previous(c)) for c in columns],
    )
    joined = lagged.join(F.broadcast(carried), [*keys, CHUNK], "left")
    return joined, {
        c: F.when(F.col("_position") == 1, F.col(_carry(c))).otherwise(F.col(_previous(c)))
        for c in columns
    }


def with_running_totals(
    df: DataFrame, totals: dict[str, Column], keys: tuple[str, ...], order: str
) -> tuple[DataFrame, dict[str, Column]]:
    """The frame and, per name, an expression for the key's total up to and including the row."""
    window = Window.partitionBy(*spread_keys(df, *keys)).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    if CHUNK not in df.columns:
        return df, {name: F.sum(amount).over(window) for name, amount in totals.items()}
    sums = _per_chunk(df, keys, [F.sum(amount).alias(name) for name, amount in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, CHUNK, *[F.sum(name).over(earlier).alias(_carry(name)) for name in totals])
    summed = df.select("*", *[F.sum(a).over(window).alias(_previous(n)) for n, a in totals.items()])
    joined = summed.join(F.broadcast(carried), [*keys, CHUNK], "left")
    return joined, {
        name: F.when(F.col(_carry(name)).isNull(), F.col(_previous(name))).otherwise(
            F.col(_carry(name)) + F.coalesce(F.col(_previous(name)), F.lit(0))
        )
        for name in totals
    }


def _per_chunk(df: DataFrame, keys: tuple[str, ...], aggregates: list[Column]) -> DataFrame:
    return df.filter(F.col(CHUNK) > WHOLE).groupBy(*keys, CHUNK).agg(*aggregates)


def _carry(name: str) -> str:
    return f"_carry_{name}"


def _previous(name: str) -> str:
    return f"_previous_{name}"
