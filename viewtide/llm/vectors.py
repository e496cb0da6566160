"""Embedding columns as whole-number matrices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Larger numbers would not leave room for exact sums of squares.
LARGEST = 1 << 26


def usable(column: str) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.col(column).isNotNull() & F.forall(column, finite)


def kept(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and `embedding` of the rows whose vector is usable."""
    return df.filter(usable("embedding")).select(*columns, F.col("embedding").cast("array<double>").alias("embedding"))


def whole(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, a row per vector.

    A ValueError tells of vectors of different lengths and of components of `LARGEST` or
    more, for which the squares would not be exact.
    """
    lists = batch.column("embedding")
    lengths = np.diff(lists.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError(f"vector components of {LARGEST // scale} or more")
    return values.astype(np.int64).reshape(len(lengths), -1) if len(values) else np.zeros((len(lengths), 0), np.int64)
