"""Column functions on vectors held as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def squared_l2(a: Column, b: Column) -> Column:
    squares = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """NULL when one of the vectors has length zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector gives NULL."""
    unit = let(norm(v), lambda size: F.transform(as_doubles(v), lambda x: x / size))
    return F.when(norm(v) > 0, unit)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scale(v: Column, factor: Column) -> Column:
    return F.transform(as_doubles(v), lambda x: x * factor)


def zeros(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)
