"""Totals at the edges of days, between observations that lie on either side of midnight.

A counter that was 10 at 23:00 and 20 at 01:00 is taken to have been 15 at midnight: a row
is generated for every midnight between two neighbouring observations, on the straight
line from one to the other, rounded down. Increments then belong to the day in which they
accrued, rather than whole to the day of the later observation, and those of a gap of
several days are shared by all of them.

Without a value on either side there is no line. Such an increment stays with the later
observation, and as everywhere a total after a missing one counts whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.expressions import day_of, increase
from viewtide.operators.ordered import with_previous
from viewtide.operators.spread import Splits, spread
from viewtide.schemas import FACTS

GENERATED = "generated"
_DAY = "day_updated_at"
_ROW = "_row"


def with_day_edges(df: DataFrame, splits: Splits | None = None, facts: tuple[str, ...] = FACTS) -> DataFrame:
    """The observations (gid, facts, updated_at) and the generated ones, marked as such.

    An observation at midnight is an edge itself.
    """
    frame, midnight = _neighbours(df, splits, facts)
    time = df.schema["updated_at"].dataType
    edges = F.transform(
        F.filter(
            F.sequence(F.date_add("_last_day", 1), "_day"),
            lambda day: day.cast(time) < F.col("updated_at"),
        ),
        lambda day: F.struct(
            *[midnight(f, day).alias(f) for f in facts], day.cast(time).alias("updated_at"), F.lit(True).alias(GENERATED)
        ),
    )
    own = F.array(F.struct(*facts, "updated_at", F.lit(False).alias(GENERATED)))
    # A sequence from tomorrow to today would count down.
    between = F.when(F.col("_last_day") < F.col("_day"), F.concat(edges, own)).otherwise(own)
    return frame.select("gid", F.inline(between))


def daily_with_edges(df: DataFrame, splits: Splits | None = None, facts: tuple[str, ...] = FACTS) -> DataFrame:
    """Increments of each video and day, cut at midnight. Those of a video add up to its last total."""
    frame, midnight = _neighbours(df, splits, facts)

    def piece(fact: str, day: Column) -> Column:
        start = F.when(day == F.col("_last_day"), F.col(f"_last_{fact}")).otherwise(midnight(fact, day))
        end = F.when(day == F.col("_day"), F.col(fact)).otherwise(midnight(fact, F.date_add(day, 1)))
        known = F.col(fact).isNotNull() & F.col(f"_last_{fact}").isNotNull()
        whole = F.when(day == F.col("_day"), increase(F.col(fact), F.col(f"_last_{fact}")))
        return F.when(known, end - start).otherwise(whole)

    pieces = F.transform(
        F.sequence(F.coalesce("_last_day", "_day"), "_day"),
        lambda day: F.struct(day.alias(_DAY), *[piece(f, day).alias(f) for f in facts]),
    )
    return frame.select("gid", F.inline(pieces)).groupBy("gid", _DAY).agg(*[F.sum(f).alias(f) for f in facts])


def _neighbours(df: DataFrame, splits: Splits | None, facts: tuple[str, ...]):
    """Each observation with the one before it, and an expression for a total at a day's beginning."""
    narrow = spread(df.select("gid", *facts, "updated_at"), splits)
    frame, previous = with_previous(narrow, (*facts, "updated_at"), ("gid",), "updated_at")
    rows = frame.select(
        "gid", *facts, "updated_at",
        *[previous[f].alias(f"_last_{f}") for f in facts], previous["updated_at"].alias("_last_updated_at"),
    )
    rows = rows.withColumns({"_day": day_of("updated_at"), "_last_day": day_of("_last_updated_at")})
    micros = lambda time: F.unix_micros(time.cast("timestamp")).cast("double")

    def midnight(fact: str, day: Column) -> Column:
        last = F.col(f"_last_{fact}")
        passed = micros(day) - micros(F.col("_last_updated_at"))
        span = micros(F.col("updated_at")) - micros(F.col("_last_updated_at"))
        return last + F.floor((F.col(fact) - last).cast("double") * passed / span)

    return rows, midnight
