"""Rounding to multiples and vector similarity, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_by_factor(x: Column, factor: int) -> Column:
    """Nearest multiple of `factor`; a tie goes to the even multiple."""
    return (F.rint(x.cast("double") / F.lit(float(factor))) * factor).cast("bigint")


def ceil_by_factor(x: Column, factor: int) -> Column:
    return (F.ceil(x.cast("double") / F.lit(float(factor))) * factor).cast("bigint")


def floor_by_factor(x: Column, factor: int) -> Column:
    return (F.floor(x.cast("double") / F.lit(float(factor))) * factor).cast("bigint")


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision; NULL where a norm is zero."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.try_divide(_dot(a, b), norms)
