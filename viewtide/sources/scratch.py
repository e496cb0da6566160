"""A fresh folder that every executor can reach."""

import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Below the folder the cluster names in `spark.checkpoint.dir`; local sessions that
    name none use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return posixpath.join(shared, f"viewtide-{uuid.uuid4().hex}")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="viewtide-")
