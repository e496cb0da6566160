"""Scalar expressions on counters and timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(timestamp: str) -> Column:
    return F.to_date(timestamp)


def hour_of(timestamp: str) -> Column:
    return F.hour(timestamp).cast("bigint")


def increase(current: Column, previous: Column) -> Column:
    """Growth since the previous total. A missing previous total counts as zero; a missing
    current total leaves the growth unknown."""
    return current - F.coalesce(previous, F.lit(0))


def decade_bin(column: str, floor: float = 1000.0, cap: float | None = None) -> Column:
    """Upper bound of the power-of-ten bin (10^(k-1), 10^k] that holds the value.

    Everything up to `floor`, missing values included, shares the lowest bin. With `cap`,
    everything above it shares the highest.
    """
    value = F.coalesce(F.col(column), F.lit(0))
    bin_ = F.greatest(F.pow(F.lit(10.0), F.ceil(F.log10(value))), F.lit(floor))
    if cap is not None:
        bin_ = F.least(bin_, F.lit(cap))
    return F.when(value <= floor, F.lit(floor)).otherwise(bin_)


# A provider's short name, a colon, and the id that the provider gives the video.
PROVIDED = r"^[^:\s]+:.+$"


def provider_id(gid: str) -> Column:
    """The part of the id before the first colon; missing if it names no provider."""
    return F.when(F.col(gid).rlike(PROVIDED), F.substring_index(gid, ":", 1))


def video_id(gid: str) -> Column:
    """The part of the id behind the first colon, further ones included."""
    return F.when(F.col(gid).rlike(PROVIDED), F.expr(f"substring(`{gid}`, instr(`{gid}`, ':') + 1)"))
