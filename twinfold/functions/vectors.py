"""Column expressions on arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def unit(v: Column) -> Column:
    """v / (|v| + 1e-10) in double precision; a zero vector stays zero."""
    v = v.cast("array<double>")
    scaled = F.transform(F.array(norm(v)), lambda n: F.transform(v, lambda x: x / (n + F.lit(1e-10))))  # the norm once
    return F.element_at(scaled, 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
