"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Days and hours are cut in this zone; override it for reports in local time.
    "spark.sql.session.timeZone": "UTC",
    # Unlike the default encoding, this one has statistics that prune by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The observations are sorted once, for the window. Where every partition of the
    # video attributes is seen at run time to fit this size, the join before it hashes
    # instead of sorting the observations a second time.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app_name: str = "viewtide", settings: dict[str, str] | None = None) -> SparkSession:
    """Start or reuse a session; master and sizing come from spark-submit or `settings`."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
