"""From observations to denormalized changes, latest states and daily increments."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.expressions import day_of, hour_of, increase, provider_id, video_id
from viewtide.operators.ordered import with_previous
from viewtide.operators.spread import FIND, Splits, found_splits, replicate, spread, spread_keys
from viewtide.schemas import (
    ATTRIBUTES,
    DAILY_COLUMNS,
    DENORM_COLUMNS,
    FACTS,
    JOINED_COLUMNS,
    LATEST_COLUMNS,
    VIDEO,
    diff,
    step,
)

# Whether a kept observation has the time of the one before it, which a key forbids.
REPEATED = "_repeated"


def denormalize(meta: DataFrame, history: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Add the video's attributes and the day to each observation.

    With `splits`, observations of split videos are joined chunk by chunk and the result
    keeps CHUNK for the steps that follow.
    """
    return with_attributes(spread(history, splits), meta, splits, JOINED_COLUMNS)


def with_attributes(
    observations: DataFrame, meta: DataFrame, splits: Splits | None, columns: tuple[str, ...]
) -> DataFrame:
    """The join behind `denormalize`, for observations that are already spread."""
    keys = spread_keys(observations, "gid")
    return (
        observations.alias("h")
        .join(replicate(meta, splits).alias("m"), keys)
        .select("h.*", *[f"m.{a}" for a in ATTRIBUTES], day_of("h.updated_at").alias("day_updated_at"))
        .select(*spread_keys(observations, *columns))
    )


def with_diffs(
    df: DataFrame,
    facts: tuple[str, ...] = FACTS,
    keys: tuple[str, ...] = VIDEO,
    order: str = "updated_at",
) -> DataFrame:
    """Add the hour of day and each fact's change since the video's previous observation.

    A video's first observation changes by its whole totals.
    """
    frame, previous = with_previous(df, facts, keys, order)
    changes = frame.select(*df.columns, *[increase(F.col(f), previous[f]).alias(diff(f)) for f in facts])
    # A second step, so that the hour is not shuffled along for the window.
    return changes.select(*df.columns, hour_of(order).alias("hour"), *map(diff, facts))


def changed_only(df: DataFrame, mode: str = "increase", facts: tuple[str, ...] = FACTS) -> DataFrame:
    """Keep observations in which at least one fact grew.

    Rows whose facts only fell are dropped as well; `mode="any"` keeps them.
    """
    if mode == "increase":
        tests = [F.col(diff(f)) > 0 for f in facts]
    elif mode == "any":
        tests = [F.col(diff(f)) != 0 for f in facts]
    else:
        raise ValueError(f"mode must be 'increase' or 'any', not {mode!r}")
    return df.filter(reduce(or_, tests))


def with_steps(
    df: DataFrame,
    facts: tuple[str, ...] = FACTS,
    keys: tuple[str, ...] = VIDEO,
    order: str = "updated_at",
    repeats: bool = False,
) -> DataFrame:
    """Add each fact's change since the video's previous *kept* observation.

    This differs from the diffs wherever the row before was dropped, and it is what the
    daily increments add up. Taken right after `changed_only` it needs no further shuffle.
    With `repeats` the same window also tells, as REPEATED, where a row repeats the key of
    the one before it; rows that share a key are neighbours there.
    """
    frame, previous = with_previous(df, (*facts, order) if repeats else facts, keys, order)
    repeated = [F.coalesce(previous[order] == F.col(order), F.lit(False)).alias(REPEATED)] if repeats else []
    return frame.select(*df.columns, *[increase(F.col(f), previous[f]).alias(step(f)) for f in facts], *repeated)


def denorm(
    meta: DataFrame,
    history: DataFrame,
    splits: Splits | None = None,
    mode: str = "increase",
    steps: bool = False,
    repeats: bool = False,
) -> DataFrame:
    """The denormalized table of kept observations with diffs and, on request, steps
    and, with those, REPEATED.

    Equal to joining first, but the windows run on the narrow observations and only kept
    rows are joined. All of it shares one shuffle and one sort of the observations, as a
    video's rows come out of the windows partitioned and ordered for the join.
    """
    by_video = ("gid",)
    kept = changed_only(with_diffs(spread(history, splits), keys=by_video), mode)
    columns = DENORM_COLUMNS
    if steps:
        kept = with_steps(kept, keys=by_video, repeats=repeats)
        columns = (*columns, *map(step, FACTS), *([REPEATED] if repeats else []))
    return with_attributes(kept, meta, splits, columns)


def latest(df: DataFrame) -> DataFrame:
    """The last kept totals of each video, with the first day it was kept.

    The attributes are constant per video and serve as grouping keys, which leaves only
    fixed-width values to aggregate and so allows hashing before the shuffle.
    """
    return (
        df.groupBy("gid", *ATTRIBUTES)
        .agg(
            *[F.max_by(f, "updated_at").alias(f) for f in FACTS],
            F.max("updated_at").alias("updated_at"),
            F.min("day_updated_at").alias("day_updated_at"),
        )
        .select(*LATEST_COLUMNS)
    )


def daily(df: DataFrame, splits: Splits | None | str = FIND) -> DataFrame:
    """Increments of each video per day on which it has a kept observation.

    Very frequent videos are found first, which for a stored table costs little; pass None
    for a frame without any that is costly to compute.
    """
    return daily_from_steps(with_steps(spread(df, found_splits(df, splits))))


def daily_from_steps(df: DataFrame) -> DataFrame:
    """The same from a frame that already has the steps, without a window."""
    return (
        df.groupBy("gid", *ATTRIBUTES, "day_updated_at")
        .agg(*[F.sum(step(f)).alias(f) for f in FACTS])
        .select(*DAILY_COLUMNS)
    )


def with_provider(df: DataFrame) -> DataFrame:
    """Add provider_id and video_id, the two parts of gid."""
    return df.withColumns({"provider_id": provider_id("gid"), "video_id": video_id("gid")})
