"""Data quality checks and profiles. Without a `limit` they return every finding."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.expressions import day_of
from viewtide.operators.spread import FIND, Splits, found_splits, replicate, spread, spread_keys
from viewtide.operators.transform import changed_only, with_diffs
from viewtide.schemas import FACTS, HISTORY_COLUMNS, VIDEO


def _first(df: DataFrame, limit: int | None, *order) -> DataFrame:
    return df if limit is None else df.orderBy(*order).limit(limit)


def meta_without_history(meta: DataFrame, history: DataFrame, limit: int | None = None) -> DataFrame:
    """Videos never observed."""
    # Reduced to one row per video before the shuffle, whatever the number of observations.
    observed = history.select("gid").distinct()
    return _first(meta.join(observed, "gid", "left_anti"), limit, "gid")


def history_without_meta(
    history: DataFrame, meta: DataFrame, limit: int | None = None, splits: Splits | None = None
) -> DataFrame:
    """Observations of unknown videos; one pass, chunk by chunk for split videos."""
    observations = spread(history, splits)
    known = replicate(meta.select("gid"), splits)
    found = observations.join(known, spread_keys(observations, "gid"), "left_anti")
    return _first(found.select(*HISTORY_COLUMNS), limit, "gid", "updated_at")


def fact_decreased(df: DataFrame, fact: str = "views", limit: int | None = None) -> DataFrame:
    """Videos whose last total is not their largest."""
    last, largest = f"last_{fact}", f"max_{fact}"
    found = (
        df.groupBy("gid")
        .agg(F.max_by(fact, "updated_at").alias(last), F.max(fact).alias(largest))
        .filter(F.col(largest) != F.col(last))
    )
    return _first(found, limit, "gid")


def video_history(df: DataFrame, gid) -> DataFrame:
    """All rows of one video, in order."""
    return df.filter(F.col("gid") == F.lit(gid)).orderBy("updated_at")


def video_day_history(df: DataFrame, gid, day: date) -> DataFrame:
    """The rows of one video on one day, in order."""
    return df.filter((F.col("gid") == F.lit(gid)) & (day_of("updated_at") == F.lit(day))).orderBy("updated_at")


def multi_updates_per_day(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The videos and days with the most rows, of those with more than one."""
    found = (
        df.groupBy("gid", day_of("updated_at").alias("day"))
        .agg(F.count("*").alias("count_gid"))
        .filter(F.col("count_gid") > 1)
    )
    return _first(found, limit, F.desc("count_gid"), "gid", "day")


def created_days(df: DataFrame) -> DataFrame:
    return df.select(day_of("created_at").alias("day")).distinct().orderBy("day")


def updated_days(df: DataFrame) -> DataFrame:
    return df.select(day_of("updated_at").alias("day")).distinct().orderBy("day")


def updates_per_video(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The videos with the most rows."""
    found = df.groupBy("gid").agg(F.count("*").alias("count_updates")).select("count_updates", "gid")
    return _first(found, limit, F.desc("count_updates"), "gid")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def changed_row_count(df: DataFrame, mode: str = "increase", splits: Splits | None | str = FIND) -> DataFrame:
    """How many rows the change filter would keep of a denormalized table.

    As in `daily`, very frequent videos are found first.
    """
    totals = spread(df.select(*spread_keys(df, *VIDEO), *FACTS, "updated_at"), found_splits(df, splits))
    return row_count(changed_only(with_diffs(totals), mode))
