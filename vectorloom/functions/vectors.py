"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.config import NORM_FLOOR, TIE_DECIMALS


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def truncate_normalize(v: Column, dim: int) -> Column:
    """First ``dim`` components brought back to length one, as floats.

    The divisor is bound once per row by a one-element list; written straight
    into the inner function it would be computed again for every component.
    """
    head = F.slice(v, 1, dim)
    scaled = F.transform(
        F.array(F.greatest(norm(head), F.lit(NORM_FLOOR))),
        lambda n: F.transform(head, lambda x: (x.cast("double") / n).cast("float")),
    )
    return F.get(scaled, F.lit(0))


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the cosine; null when a vector has length zero."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def tie_safe(distance: Column) -> Column:
    return F.round(distance, TIE_DECIMALS)


def score(distance: Column) -> Column:
    """Similarity shown to users."""
    return F.round(F.lit(1.0) - distance, 4)


def to_text(v: Column) -> Column:
    """``[a,b,...]``"""
    return F.concat(F.lit("["), F.array_join(v.cast("array<string>"), ","), F.lit("]"))


def from_text(text: Column) -> Column:
    return F.from_json(text, "array<float>")


def of_size(v: Column, dim: int) -> Column:
    """The vector as floats; a missing or wrongly sized one stops the write."""
    typed = v.cast("array<float>")
    message = F.concat(
        F.lit(f"expected {dim} dimensions, not "), F.coalesce(F.size(typed), F.lit(-1)).cast("string")
    )
    return F.when(typed.isNotNull() & (F.size(typed) == dim), typed).otherwise(
        F.raise_error(message).cast("array<float>")
    )
