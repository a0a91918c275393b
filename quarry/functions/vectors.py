"""Vector column expressions.

These higher-order-function forms are the readable, per-row reference path.
Bulk scoring goes through the Arrow block scorer in ``operators.similarity``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def l2_norm(vec: Column | str) -> Column:
    v = _c(vec)
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalise(vec: Column | str) -> Column:
    """Unit-length vector (array<double>); a zero vector stays zero so it scores 0."""
    v = _c(vec)
    n = l2_norm(v)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, x: acc + x,
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def head(vec: Column | str, n: int = 5) -> Column:
    return F.slice(_c(vec), 1, n)
