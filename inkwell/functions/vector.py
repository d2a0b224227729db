"""Vector functions over arrays as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """The inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column) -> Column:
    """A vector of unit length; one of length zero is null."""
    length = F.nullif(norm(a), F.lit(0.0))
    return F.when(length.isNotNull(), F.transform(a, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))
