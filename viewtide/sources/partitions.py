"""Stage tables cut into partitions, by day or by part of the videos, that are replaced,
read and removed one by one."""

import posixpath
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.sources.stages import stage_path

DAY = "day_updated_at"


def write_partitions(df: DataFrame, directory: str, name: str, by: str = DAY, sort_by: tuple[str, ...] = ()) -> None:
    """Replace the partitions that `df` has rows of; the others keep their files.

    Rows are brought together by partition, so that each has few files; one with very many
    rows is cut at run time into several tasks and files. Rows that are read from the same
    table are safe to write, as partitions are exchanged after all rows are written.
    """
    (
        _dealt(df, by, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
        .parquet(stage_path(directory, name))
    )


def write_all_partitions(df: DataFrame, directory: str, name: str, by: str = DAY, sort_by: tuple[str, ...] = ()) -> None:
    """Replace the whole table. One without rows is a file that tells its columns."""
    path = stage_path(directory, name)
    _dealt(df, by, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
    if not partition_values(df.sparkSession, directory, name, by):
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)


def _dealt(df: DataFrame, by: str, sort_by: tuple[str, ...]) -> DataFrame:
    return df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *sort_by)


def read_days(
    spark: SparkSession, directory: str, name: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The rows of the days from `since` to `until`, both included; no other day is listed."""
    rows = spark.read.parquet(stage_path(directory, name))
    if since is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(until))
    return rows


def partition_values(spark: SparkSession, directory: str, name: str, by: str = DAY) -> list[str]:
    """The partitions a table has, from the names of its folders. None if there is no table."""
    files, path = _files(spark, stage_path(directory, name))
    if not files.exists(path):
        return []
    names = (entry.getPath().getName() for entry in files.listStatus(path))
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{by}="))


def drop_partitions(spark: SparkSession, directory: str, name: str, values: Iterable, by: str = DAY) -> None:
    """Delete whole partitions; those the table does not have are passed over."""
    for value in values:
        files, path = _files(spark, _folder(directory, name, by, value))
        files.delete(path, True)


def move_partitions(
    spark: SparkSession, directory: str, name: str, values: Iterable, archive: str, by: str = DAY
) -> None:
    """Move whole partitions into the table of the same name in another folder, replacing those there."""
    for value in values:
        files, path = _files(spark, _folder(directory, name, by, value))
        _, target = _files(spark, _folder(archive, name, by, value))
        if files.exists(path):
            files.mkdirs(target.getParent())
            files.delete(target, True)
            if not files.rename(path, target):
                raise OSError(f"could not move {path} to {target}")


def purge(spark: SparkSession, directory: str, name: str, before: date, archive: str | None = None) -> list[date]:
    """Remove the days before `before`, into `archive` if there is one, and return them."""
    old = [v for v in partition_values(spark, directory, name) if date.fromisoformat(v) < before]
    if archive is None:
        drop_partitions(spark, directory, name, old)
    else:
        move_partitions(spark, directory, name, old, archive)
    return [date.fromisoformat(v) for v in old]


def _folder(directory: str, name: str, by: str, value) -> str:
    return posixpath.join(stage_path(directory, name), f"{by}={value}")


def _files(spark: SparkSession, path: str):
    """The file system that holds the path, and the path as it knows it."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path
