"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is missing or lengths differ, 0 if a norm is 0."""
    n = norm(a) * norm(b)
    return F.when(a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)), F.when(n == 0, 0.0).otherwise(dot(a, b) / F.nullif(n, F.lit(0.0))))


def cosine_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.when(F.size(a) > 0, cosine(a, b)), F.lit(0.0))
