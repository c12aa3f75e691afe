"""Vectors as matrices of long integers, shared by the operators that work on whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete(vectors: DataFrame, vector: str, also: Column | None = None) -> tuple[DataFrame, int]:
    """Rows whose vector (as ``v``, array<double>) holds finite numbers alone and has the most frequent length (ties: the shorter), and that length.

    ``also`` is a further condition on the length ``n``. Without any such row the length is 0.
    """
    v = F.col("v")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    fine = vectors.withColumn("v", F.col(vector).cast("array<double>")).where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    lengths = fine.groupBy(F.size("v").alias("n")).count()
    common = (lengths if also is None else lengths.where(also)).orderBy(F.desc("count"), "n").first()
    dim = common["n"] if common else 0
    return fine.where(F.size("v") == dim), dim


def scaled(v: Column, times: int, plus: int, most: int) -> Column:
    """floor(times * component) + plus for each component, held to the range from -most to most (before plus)."""
    return F.transform(v, lambda e: F.floor(F.greatest(F.least(e * F.lit(float(times)), F.lit(float(most))), F.lit(-float(most)))) + F.lit(plus))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind: type = np.int64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)
