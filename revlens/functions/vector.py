"""Array-vector column functions (F34 and helpers) — higher-order SQL
functions, evaluated in the JVM without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def as_double_array(col) -> Column:
    return _c(col).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either norm is 0 (or a vector is NULL)."""
    den = norm(a) * norm(b)
    return F.coalesce(F.when(den != 0, dot(a, b) / den), F.lit(0.0))


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)
