"""Reading the input tables, and tables between the steps of an operator."""

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.sources.scratch import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    What follows starts from the written table: it is computed once, and an executor
    that is lost later takes nothing of it along.
    """
    spark = df.sparkSession
    path = posixpath.join(scratch_dir(spark), name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reserved(df: DataFrame, prefix: str) -> None:
    """Raise if the caller has columns under the names an operator keeps for itself."""
    clashing = [c for c in df.columns if c.lower().startswith(prefix)]
    if clashing:
        raise ValueError(f"column names that begin with {prefix} are reserved: {clashing}")


def steady(df: DataFrame) -> DataFrame:
    """The rows, dealt to the same partitions in the same order whenever they are read.

    Row numbers taken in two readings agree only then. How files are cut into partitions
    follows the number of cores at hand at that moment, unless the least number of
    partitions is set: it is set here, for the session, where the user has not done so.
    Rows that do not come straight from files are written first.
    """
    spark = df.sparkSession
    least = "spark.sql.files.minPartitionNum"
    if spark.conf.get(least, None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set(least, str(cores))
    plan = df._jdf.queryExecution().sparkPlan()
    leaves = plan.collectLeaves()
    from_files = leaves.length() == 1 and leaves.apply(0).nodeName().startswith("Scan parquet")
    moved = any(step in plan.toString() for step in ("Exchange", "Join", "Aggregate", "Sort", "Window", "Limit", "MapIn", "Sample"))
    return df if from_files and not moved else store(df, "rows")
