"""Vector arithmetic on array columns, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x)


def norm(a: str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str, b: str) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
