"""Vectors as arrays of floats, by higher-order functions inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column, assume_normalized: bool = False) -> Column:
    """Null where a vector is zero; for unit vectors the dot product alone."""
    return dot(a, b) if assume_normalized else F.try_divide(dot(a, b), norm(a) * norm(b))
