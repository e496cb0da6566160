"""Columns, keys and constraints of the two inputs and the three derived tables."""

from dataclasses import dataclass

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

FACTS = ("views", "likes", "dislikes", "comments")
ATTRIBUTES = ("user_id", "category_id", "created_at", "duration")

# A video never changes category, so grouping by both keys equals grouping by gid. The id
# comes first because sorts on it tell rows apart sooner.
VIDEO = ("gid", "category_id")

META = StructType([
    StructField("gid", StringType()),
    StructField("user_id", StringType()),
    StructField("category_id", LongType()),
    StructField("created_at", TimestampType()),
    StructField("duration", LongType()),
])

HISTORY = StructType([
    StructField("gid", StringType()),
    *[StructField(fact, LongType()) for fact in FACTS],
    StructField("updated_at", TimestampType()),
])

# Widest text each column may hold, in bytes.
MAX_BYTES = {"gid": 14, "user_id": 24}


def diff(fact: str) -> str:
    """Change of a fact since the video's previous observation."""
    return f"{fact}_diff"


def step(fact: str) -> str:
    """Change of a fact since the video's previous *kept* observation."""
    return f"{fact}_step"


@dataclass(frozen=True)
class Constraints:
    key: tuple[str, ...]
    not_null: tuple[str, ...]


CONSTRAINTS = {
    "meta": Constraints(("gid",), ("gid",)),
    "history": Constraints(("gid", "updated_at"), ("gid", "updated_at")),
    "denorm": Constraints(
        (*VIDEO, "day_updated_at", "updated_at"),
        ("gid", "updated_at", "category_id", "day_updated_at"),
    ),
    "latest": Constraints((*VIDEO, "updated_at"), ("gid", "updated_at", "day_updated_at")),
    "daily": Constraints((*VIDEO, "day_updated_at"), ("gid", "category_id", "day_updated_at")),
}

HISTORY_COLUMNS = ("gid", *FACTS, "updated_at")
JOINED_COLUMNS = (*HISTORY_COLUMNS, *ATTRIBUTES, "day_updated_at")
DENORM_COLUMNS = (*JOINED_COLUMNS, "hour", *map(diff, FACTS))
LATEST_COLUMNS = JOINED_COLUMNS
DAILY_COLUMNS = ("gid", *FACTS, *ATTRIBUTES, "day_updated_at")
