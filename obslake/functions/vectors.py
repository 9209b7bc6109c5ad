"""Vector expressions. They stay on the JVM; sums are taken in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALLEST_NORM = 1e-12


def literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def dot(a: Column, b: Column) -> Column:
    """Sum of products. NULL when a vector is NULL or the lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    squares = F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of the two vectors scaled to length one; tiny norms are floored."""
    floor = F.lit(SMALLEST_NORM)
    return dot(a, b) / (F.greatest(norm(a), floor) * F.greatest(norm(b), floor))


def to_json(vector: Column) -> Column:
    return F.to_json(vector)


def from_json(text: Column) -> Column:
    return F.from_json(text, T.ArrayType(T.DoubleType()))
