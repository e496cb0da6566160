"""The five reports. Each groups by few keys, so rows are reduced before the shuffle."""

from datetime import date
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.expressions import decade_bin
from viewtide.schemas import FACTS, diff


def _totals(suffix=lambda fact: fact) -> list[Column]:
    return [F.sum(suffix(f)).alias(f"total_{f}") for f in FACTS]


def category_totals(latest: DataFrame) -> DataFrame:
    """Totals accrued within each category."""
    return latest.groupBy("category_id").agg(*_totals()).orderBy(F.desc("total_views"), "category_id")


def daily_average(daily: DataFrame) -> DataFrame:
    """The average and the largest daily increments per category and day.

    Only videos with a kept observation on that day take part.
    """
    measures = [m for f in (*FACTS, "duration") for m in (F.avg(f).alias(f"avg_{f}"), F.max(f).alias(f"max_{f}"))]
    return daily.groupBy("category_id", "day_updated_at").agg(*measures).orderBy("category_id", "day_updated_at")


def videos_per_bin(latest: DataFrame, fact: str, floor: float = 1000.0, cap: float | None = None) -> DataFrame:
    """Number of videos per order of magnitude of a fact, and category."""
    group = f"total_{fact}_group"
    return (
        latest.groupBy(decade_bin(fact, floor, cap).alias(group), "category_id")
        .agg(F.count("*").alias("count_videos"))
        .select("count_videos", group, "category_id")
        .orderBy(group, "category_id")
    )


def view_bins(latest: DataFrame, cap: float | None = None) -> DataFrame:
    return videos_per_bin(latest, "views", cap=cap)


def like_bins(latest: DataFrame, cap: float | None = None) -> DataFrame:
    return videos_per_bin(latest, "likes", cap=cap)


def hourly_totals(denorm: DataFrame, as_of: date, days: int = 7, measure: str = "total") -> DataFrame:
    """Totals by category and hour of day over the days before `as_of`.

    The default adds up running totals, as the original report does; `measure="increment"`
    adds up the changes instead.
    """
    if measure not in ("total", "increment"):
        raise ValueError(f"measure must be 'total' or 'increment', not {measure!r}")
    since = F.lit(as_of) - F.expr(f"interval {int(days)} days")
    return (
        denorm.filter(F.col("updated_at") > since)
        .groupBy("category_id", "hour")
        .agg(*(_totals() if measure == "total" else _totals(diff)))
        .orderBy(F.desc("total_views"), "category_id", "hour")
    )


def hour_table(denorm: DataFrame) -> DataFrame:
    """Totals and increments by category, day and hour, those of exactly midnight apart.

    A few rows per day, from which the hourly report of any days can be had: its bound is a
    midnight, and only what lies exactly there is neither before nor after it.
    """
    midnight = F.col("updated_at") == F.col("day_updated_at").cast(denorm.schema["updated_at"].dataType)
    return denorm.groupBy("category_id", "day_updated_at", "hour", midnight.alias("midnight")).agg(
        *[F.sum(f).alias(f) for f in FACTS], *[F.sum(diff(f)).alias(diff(f)) for f in FACTS]
    )


def hourly_totals_of(hours: DataFrame, as_of: date, days: int = 7, measure: str = "total") -> DataFrame:
    """`hourly_totals` from the hour table."""
    if measure not in ("total", "increment"):
        raise ValueError(f"measure must be 'total' or 'increment', not {measure!r}")
    since = F.date_sub(F.lit(as_of), int(days))
    later = (F.col("day_updated_at") > since) | ((F.col("day_updated_at") == since) & ~F.col("midnight"))
    return (
        hours.filter(later)
        .groupBy("category_id", "hour")
        .agg(*(_totals() if measure == "total" else _totals(diff)))
        .orderBy(F.desc("total_views"), "category_id", "hour")
    )


def fact_correlation(latest: DataFrame, facts: tuple[str, ...] = FACTS) -> DataFrame:
    """Pearson's correlation of each two facts over the videos of a category.

    Videos without a value of either fact are left out of that pair. Spark merges means and
    co-moments of the tasks, one row per category. Without variance it is missing.
    """
    pairs = list(combinations(facts, 2))

    def correlation(a: str, b: str) -> Column:
        """What `corr` is, but missing where that would divide by zero."""
        spread = [F.stddev_pop(F.when(F.col(other).isNotNull(), F.col(fact))) for fact, other in ((a, b), (b, a))]
        return F.try_divide(F.covar_pop(a, b), spread[0] * spread[1])

    both = lambda a, b: F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
    found = latest.groupBy("category_id").agg(*[
        column for a, b in pairs
        for column in (correlation(a, b).alias(f"_{a}_{b}"), both(a, b).alias(f"_n_{a}_{b}"))
    ])
    rows = F.array(*[
        F.struct(
            F.lit(a).alias("fact"), F.lit(b).alias("other_fact"), F.col(f"_n_{a}_{b}").alias("count_videos"),
            F.round(f"_{a}_{b}", 6).alias("correlation"),
        ) for a, b in pairs
    ])
    return found.select("category_id", F.inline(rows))
