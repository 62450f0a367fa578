"""Vectors as arrays: similarity in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 where either has no length, null where either is null."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(F.when(n.isNotNull(), F.lit(0.0)))
