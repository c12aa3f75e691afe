"""Vector columns (array<float>), computed in double precision on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity within [0, 1]; 0 for a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(a, b) / size))).otherwise(0.0)


def unit(a: Column) -> Column:
    """Scaled to length 1; a zero vector stays."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a)


def parsed(text: Column) -> Column:
    """A vector from its text form [1.0, 2.0]; null where it is none."""
    return F.from_json(text, "array<float>")
