"""Video statistics derived from the `customer` and `events` test tables.

Every customer is a video and every event one observation of it. Video and user ids are
integers here and categories are text; no operator depends on their types.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.operators.ordered import with_running_totals
from viewtide.operators.spread import Splits, find_splits, spread
from viewtide.schemas import FACTS, HISTORY_COLUMNS

_CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    hour = F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0")
    return customer.select(
        F.col("c_custkey").alias("gid"),
        F.col("c_nationkey").cast("bigint").alias("user_id"),
        F.col("c_mktsegment").alias("category_id"),
        F.concat(F.lit("2024-01-01 "), hour, F.lit(":00:00")).cast("timestamp_ntz").alias("created_at"),
        (30 + F.col("c_custkey") % 600).cast("bigint").alias("duration"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, named as observations, before their totals are known."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("user_id").alias("gid"), F.col("ts").alias("updated_at"), "event_id", "event_type", "value"
    )


def history(spark: SparkSession, sf_dir: str, splits: Splits | None = None) -> DataFrame:
    """Running totals per video; `splits` as found on `observations`."""
    frame, totals = with_running_totals(
        spread(observations(spark, sf_dir), splits),
        {
            "views": F.when(F.col("event_type") == "error", _correction()).otherwise(_growth()),
            "likes": _is("click"),
            "dislikes": _is("purchase"),
            "comments": _is("signup"),
        },
        ("gid",),
        "updated_at",
    )
    return frame.select(
        "gid",
        F.greatest(totals["views"], F.lit(0)).cast("bigint").alias("views"),
        totals["likes"].cast("bigint").alias("likes"),
        totals["dislikes"].cast("bigint").alias("dislikes"),
        F.when(F.col("event_id") % 17 != 0, totals["comments"]).cast("bigint").alias("comments"),
        "updated_at",
    ).select(*HISTORY_COLUMNS)


def history_splits(spark: SparkSession, sf_dir: str, **limits: int) -> Splits | None:
    return find_splits(observations(spark, sf_dir), **limits)


def _growth() -> Column:
    """Views gained: each video's id decides its order of magnitude."""
    scale = F.pow(F.lit(10), F.col("gid") % 5).cast("bigint")
    return F.floor(F.col("value") / 10).cast("bigint") * scale


def _correction() -> Column:
    return F.when(F.col("event_id") % 3 == 0, F.lit(-5)).otherwise(F.lit(0))


def _is(event_type: str) -> Column:
    return F.when(F.col("event_type") == event_type, F.lit(1)).otherwise(F.lit(0))


# Inputs as CSV lines, for the load: text video ids, numeric categories and quoted
# integers. `meta` and `history` above hold the same videos and totals.


def video_id(gid: Column) -> Column:
    """Digits in reverse, so that ids differ early, as real ones do."""
    return F.concat(F.lit("YT:"), F.reverse(F.lpad(gid.cast("string"), 11, "0")))


def csv_meta(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Lines of the meta file; some videos have no duration."""
    rows = _copied(meta(spark, sf_dir), copies)
    duration = F.when(F.col("gid") % 13 == 0, F.lit("")).otherwise(F.col("duration").cast("string"))
    return rows.select(
        F.concat_ws(
            ",",
            video_id(F.col("gid")),
            F.concat(F.lit("UC"), F.col("user_id").cast("string")),
            (10 + 10 * (F.col("gid") % 2)).cast("string"),
            F.date_format("created_at", _CSV_TIME),
            duration,
        ).alias("line")
    )


def csv_history(spark: SparkSession, sf_dir: str, splits: Splits | None = None, copies: int = 1) -> DataFrame:
    """Lines of the history file: quoted integers, `""` for a missing one."""
    rows = _copied(history(spark, sf_dir, splits), copies)
    return rows.select(F.concat_ws(",", *csv_history_fields()).alias("line"))


def csv_history_fields() -> list[Column]:
    return [
        _quoted(video_id(F.col("gid"))),
        *[_quoted(F.coalesce(F.col(fact).cast("string"), F.lit(""))) for fact in FACTS],
        F.date_format("updated_at", _CSV_TIME),
    ]


def csv_history_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every fourth is faulty, each kind of fault in turn."""
    gid, *_, updated_at = csv_history_fields()
    ten, none = F.lit('"10"'), F.lit('""')
    faults = [
        (gid, ten, F.lit("x"), none, ten, updated_at),
        (gid, ten, ten, ten),
        (gid, ten, ten, ten, ten, F.lit("notadate")),
        (gid, F.lit('"1,2"'), ten, ten, ten, updated_at),
        (F.lit(""), ten, ten, ten, ten, updated_at),
        (gid, ten, ten, ten, ten, F.lit("")),
        (F.lit('"YT:much-too-long"'), ten, ten, ten, ten, updated_at),
        (gid, ten, ten, ten, ten, updated_at, ten),
        (gid, ten, ten, ten, ten, F.lit("12:00:00")),
        (gid, ten, ten, ten, ten, F.lit("2018")),
        (gid, F.lit('" 7"'), ten, ten, ten, updated_at),
        (F.lit("  "),),
    ]
    line = F.concat_ws(",", gid, ten, none, F.lit("2"), none, updated_at)
    for kind, fields in enumerate(faults):
        line = F.when(F.col("event_id") % 48 == 4 * kind, F.concat_ws(",", *fields)).otherwise(line)
    return observations(spark, sf_dir).select(line.alias("line"))


def csv_history_of_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the history file from three providers; every sixth id names none, or nothing else."""
    gid, kind = F.lpad(F.col("gid").cast("string"), 6, "0"), F.col("event_id") % 6
    named = (
        F.when(kind < 2, F.concat(F.lit("YT:"), gid)).when(kind == 2, F.concat(F.lit("VM:a:"), gid))
        .when(kind < 5, F.concat(F.lit("D:"), gid))
        .otherwise(F.when(F.col("event_id") % 4 == 1, gid).otherwise(F.when(F.col("event_id") % 8 == 3, F.lit("YT:")).otherwise(F.concat(F.lit(":"), gid))))
    )
    fields = [named, *[F.lit("1")] * len(FACTS), F.date_format("updated_at", _CSV_TIME)]
    return observations(spark, sf_dir).select(F.concat_ws(",", *fields).alias("line"))


def _copied(df: DataFrame, copies: int) -> DataFrame:
    """Each video this many times, under ids of their own."""
    if copies == 1:
        return df
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return df.withColumn("copy", copy).withColumn("gid", F.col("gid") * copies + F.col("copy")).drop("copy")


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))
