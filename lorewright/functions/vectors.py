"""Vector functions on arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; vectors of different sizes are an error."""
    wrong = F.raise_error(F.lit("vectors of different sizes")).cast("double")
    total = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), total).otherwise(wrong)


def norm(a: Column) -> Column:
    """Euclidean norm."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; a zero vector or different sizes are an error, null gives null."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.raise_error(F.lit("zero vector has no cosine")).cast("double")).otherwise(dot(a, b) / size)


def parsed(text: Column) -> Column:
    """A vector written as '[1,2]'; null and empty ones are null."""
    values = F.from_json(text, "array<double>")
    return F.when(F.size(values) > 0, values)


def single(vectors: Column) -> Column:
    """The one vector of an array that must hold exactly one, not empty."""
    wrong = F.raise_error(F.lit("exactly one vector is expected")).cast("array<double>")
    return F.when((F.size(vectors) == 1) & (F.size(F.get(vectors, 0)) > 0), F.get(vectors, 0).cast("array<double>")).otherwise(wrong)
