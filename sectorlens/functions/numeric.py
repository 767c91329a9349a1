"""Numeric expressions: vectors, angles and scores."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Inner product of two numeric arrays, in double."""
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0), lambda total, x: total + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two numeric arrays; null when one of them has length zero."""
    norm = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norm > 0, dot(left, right) / norm)


def polarity(negative: Column, neutral: Column, positive: Column) -> Column:
    """Softmax probability of positive minus that of negative, three decimals."""
    top = F.greatest(negative, neutral, positive)
    n, o, p = (F.exp(x - top) for x in (negative, neutral, positive))
    return F.round((p - n) / (n + o + p), 3)


def circle_offset(index: Column, count: Column, radius: float) -> tuple[Column, Column]:
    """(north, east) offset of position ``index`` of ``count`` on a circle."""
    angle = F.lit(2 * math.pi) * index / count
    return F.lit(radius) * F.sin(angle), F.lit(radius) * F.cos(angle)


def plain_number(value: Column, decimals: int = 4) -> Column:
    """Text of a number with a fixed count of decimals, never in scientific form."""
    return value.cast(f"decimal(38,{decimals})").cast("string")
