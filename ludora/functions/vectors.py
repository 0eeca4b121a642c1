"""Dense-vector column functions over array<double> (FN-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a: Column, b: Column, eps: float = 1e-8) -> Column:
    """Cosine with an additive epsilon in the denominator, as FN-10."""
    return dot(a, b) / (l2_norm(a) * l2_norm(b) + F.lit(eps))


def scale(a: Column, s: Column) -> Column:
    return F.transform(a, lambda v: v * s)
