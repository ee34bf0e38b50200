"""Vector arithmetic on array columns."""

from pyspark.sql import Column, functions as F

EPSILON = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda total, x: total + x,
    )


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column) -> Column:
    """Scale to unit length; a zero vector stays zero."""
    length = F.greatest(norm(v), F.lit(EPSILON))
    return F.transform(v, lambda x: x.cast("double") / length)


def cosine_score(a: Column, b: Column) -> Column:
    """1 - cosine distance."""
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(EPSILON))
