"""Parquet tables between the phases, and CSV reports."""

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

REPORTS = "reports"
REJECTS = "rejects"


def stage_path(directory: str, name: str) -> str:
    return posixpath.join(directory, name)


def read_stage(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(stage_path(directory, name))


def write_stage(
    df: DataFrame, directory: str, name: str, sort_by: tuple[str, ...] = (), layout: bool = False
) -> None:
    """Replace the stage.

    `sort_by` orders the rows within each file. With `layout` the files also take disjoint
    ranges of those columns, so that their statistics prune lookups; a frequent video then
    spans several files along its last column instead of filling one task. This costs a
    shuffle of the table.
    """
    if layout:
        df = df.repartitionByRange(*sort_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(stage_path(directory, name))


def write_report(df: DataFrame, directory: str, name: str) -> None:
    """Replace the report: CSV with a header, in the report's order over its part files."""
    df.write.mode("overwrite").option("header", True).csv(stage_path(directory, name))


def read_report(spark: SparkSession, directory: str, name: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(stage_path(directory, name))
