"""What grew most in the last hour, day and week."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.schemas import diff

HOURS = {"hour": 1, "day": 24, "week": 168}


def trending(
    denorm: DataFrame, as_of: datetime, k: int = 10, by: str = "gid", fact: str = "views", hours: dict[str, int] = HOURS
) -> DataFrame:
    """The `k` videos, or users with by="user_id", of each category whose `fact` grew most
    in each window that ends at `as_of`; equally many in the order of their ids.

    One scan of the widest window serves all. Increases are added up before they are
    shuffled, and Spark keeps `k` rows per window and category on each task before the
    ranks are shuffled, so a category with all videos sends no more than the others.
    """
    time = denorm.schema["updated_at"].dataType
    at = lambda moment: F.lit(moment.isoformat(sep=" ")).cast(time)
    since = {name: at(as_of - timedelta(hours=h)) for name, h in hours.items()}
    widest = max(hours, key=hours.get)
    recent = denorm.filter((F.col("updated_at") > since[widest]) & (F.col("updated_at") <= at(as_of)))
    reached = F.array_compact(F.array(*[F.when(F.col("updated_at") > s, F.lit(name)) for name, s in since.items()]))
    grown = (
        recent.select(F.explode(reached).alias("window"), "category_id", by, F.col(diff(fact)).alias("_grown"))
        .groupBy("window", "category_id", by).agg(F.sum("_grown").alias(f"{fact}_increase"))
    )
    best = Window.partitionBy("window", "category_id").orderBy(F.desc(f"{fact}_increase"), by)
    return grown.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
