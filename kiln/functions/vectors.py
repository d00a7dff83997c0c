"""Vector expressions (cosine distance) on array<float> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    prod = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - a.b / (|a| |b|), the distance of a cosine-space collection; null
    where a vector is null or of length zero and so has no direction."""
    return F.lit(1.0) - F.try_divide(_dot(a, b), norm(a) * norm(b))


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])
