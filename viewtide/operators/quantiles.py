"""Exact quantiles of whole numbers per group, without bringing a group's values together.

A quantile lies between the values of two ranks. For every rank wanted an interval of
values that holds it is known, at first all between the group's least and greatest. Each
pass counts the values of the open intervals in `BINS` bins, picks the bin of the rank, and
goes on with the least and greatest value in it, so an interval is `BINS` times narrower
after each pass and closed when one value is left: at most eight passes for any longs, and
for most data three. A pass sends one count per task, interval and bin, however many rows a
group has. Intervals are equal or apart, so a value is counted at most once.

What is known of the intervals is a written table of a few rows per group.
"""

import posixpath

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.sources.scratch import scratch_dir

BINS = 256
# Up to so many groups, the few rows that each has are sent to all tasks.
FEW_GROUPS = 20_000
SHARES = (0.5, 0.8, 0.9, 0.95)


def quantiles(df: DataFrame, by: str, column: str, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """Per group: values, least, greatest, average and one column per share, `p50` for 0.5.

    Missing values are left out, and so are groups without any others. A quantile between
    two values is on the straight line between them. A missing group is a group.
    """
    rows = df.select(F.col(by).alias("g"), F.col(column).cast("bigint").alias("v")).filter(F.col("v").isNotNull())
    folder = scratch_dir(df.sparkSession)

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = posixpath.join(folder, name)
        table.write.parquet(path)
        return df.sparkSession.read.schema(table.schema).parquet(path)

    groups = keep(rows.groupBy("g").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("mean")
    ), "groups")
    place = {share: F.lit(share) * (F.col("n") - 1).cast("double") for share in shares}
    ends = [end(place[share]).cast("bigint") for share in shares for end in (F.floor, F.ceil)]
    ranks = keep(groups.select(
        "g", F.explode(F.array_distinct(F.array(*ends))).alias("rank"), "low", "high", F.lit(0).cast("bigint").alias("below")
    ), "ranks-0")
    passes, few = 0, groups.count() <= FEW_GROUPS
    while not ranks.filter("low < high").isEmpty():
        passes += 1
        ranks = keep(_narrowed(rows, ranks, few), f"ranks-{passes}")
    values = ranks.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "low"))).alias("at"))
    joined = groups.join(values.withColumnRenamed("g", "other"), F.col("g").eqNullSafe(F.col("other")))

    def quantile(share: float):
        low = F.element_at("at", F.floor(place[share]).cast("bigint"))
        high = F.element_at("at", F.ceil(place[share]).cast("bigint"))
        return low + (high - low) * (place[share] - F.floor(place[share]))

    return joined.select(
        F.col("g").alias(by), F.col("n").alias(f"count_{column}"), F.col("low").alias(f"min_{column}"),
        F.col("high").alias(f"max_{column}"), F.col("mean").alias(f"avg_{column}"),
        *[quantile(share).cast("double").alias(f"p{round(100 * share)}_{column}") for share in shares],
    )


def _narrowed(rows: DataFrame, ranks: DataFrame, few: bool) -> DataFrame:
    """One pass: the bin of each open interval that holds its rank.

    With very many groups the rows are joined by group, and a group that is much larger
    than others is split by Spark's skew handling.
    """
    is_open = F.col("low") < F.col("high")
    intervals = ranks.filter(is_open).select(F.col("g").alias("of"), "low", "high", "below").distinct()
    inside = F.col("g").eqNullSafe(F.col("of")) & F.col("v").between(F.col("low"), F.col("high"))
    # Halves before the difference, which two longs may not have room for.
    part = ((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)).cast("double")
    bins = (
        rows.join(F.broadcast(intervals) if few else intervals, inside)
        .groupBy("of", "low", "high", "below", F.least(F.floor(part * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("n"), F.min("v").alias("bin_low"), F.max("v").alias("bin_high"))
    )
    earlier = Window.partitionBy("of", "low").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = bins.withColumn("bin_below", F.col("below") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    found = ranks.filter(is_open).select("g", "rank", F.col("low").alias("from")).join(
        counted,
        F.col("g").eqNullSafe(F.col("of")) & (F.col("from") == F.col("low"))
        & (F.col("rank") >= F.col("bin_below")) & (F.col("rank") < F.col("bin_below") + F.col("n")),
    ).select("g", "rank", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"), F.col("bin_below").alias("below"))
    return ranks.filter(~is_open).unionByName(found)
