"""Vector functions over ARRAY<DOUBLE>. Vectors of different lengths meet on the shorter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(a: Column, b: Column, f) -> Column:
    n = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), f), F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _pairs(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def dot_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 if either vector is zero."""
    norms = norm(a) * norm(b)
    return F.when(norms == 0, 1.0).otherwise(1.0 - dot(a, b) / norms)


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_pairs(a, b, lambda x, y: (x - y) * (x - y)))


DISTANCES = {"DOT_PRODUCT": dot_distance, "COSINE": cosine_distance, "EUCLIDEAN": euclidean_distance}


def finite(a: Column) -> Column:
    """no component is null, NaN or infinite."""
    return F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
