"""Shared handling of vector tables: valid rows, content keys, numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, no null or non-finite component, not zero (and not empty)."""
    d = F.col(vector).cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(d, lambda x: x != 0), F.lit(False))


def content_key(vector: str) -> Column:
    """Equal for equal vectors (two independent 64-bit hashes; -0.0 counts as 0.0)."""
    d = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    return F.concat(F.hex(F.xxhash64(F.lit(1), d)), F.hex(F.xxhash64(F.lit(2), d)))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as one float64 matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return np.zeros((0, 0))
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def dimension(vectors: DataFrame, vector: str) -> int:
    """Length of the usable vectors (the most frequent one's; 0 for none)."""
    r = vectors.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "d").first()
    return r["d"] if r else 0
