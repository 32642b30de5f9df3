"""Arithmetic on array<float> columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, query: list[float]) -> Column:
    """1 - cosine with a fixed query; null where either has no length."""
    size = sum(float(x) ** 2 for x in query) ** 0.5
    value = F.array(*(F.lit(float(x)) for x in query))
    total = dot(a, value)
    return F.lit(1.0) - F.try_divide(total, norm(a) * F.lit(size))


def weighted_mean(a: Column, b: Column, weight_a: Column, weight_b: Column) -> Column:
    """The mean of two vectors by weight, scaled to length one; a zero mean stays zero."""
    mean = F.zip_with(a, b, lambda x, y: (x * weight_a + y * weight_b) / (weight_a + weight_b))
    return F.get(F.transform(F.array(mean), lambda m: F.transform(m, lambda x: x / F.when(norm(m) == 0, F.lit(1.0)).otherwise(norm(m)))), F.lit(0))
