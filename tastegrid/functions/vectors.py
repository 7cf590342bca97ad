"""Vector expressions on ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegrid.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    measured = let(a.cast("array<double>"), lambda v: F.struct(v.alias("v"), norm(v).alias("n")))
    return let(measured, lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])).otherwise(s["v"]))


def cosine_similarity(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def relevance_from_distance(d: Column) -> Column:
    """Distance to similarity: 1 - d/2 up to 2, then 1/(1+d)."""
    return F.when(d <= 2.0, 1.0 - d / 2.0).otherwise(F.greatest(F.lit(0.0), 1.0 / (1.0 + d)))
