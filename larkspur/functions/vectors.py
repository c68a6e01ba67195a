"""Sparse vectors as token -> weight maps, for looking at single records.

Searches over many records use the long form in :mod:`larkspur.operators.similarity`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_product(a: Column, b: Column) -> Column:
    """Sum of products over the keys both maps hold; a missing key counts as 0."""
    return F.aggregate(
        F.map_entries(a), F.lit(0.0),
        lambda total, entry: total + entry.getField("value").cast("double") * F.coalesce(
            F.try_element_at(b, entry.getField("key")).cast("double"), F.lit(0.0)))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(
        F.map_values(a), F.lit(0.0),
        lambda total, weight: total + weight.cast("double") * weight.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Dot product over both norms; NULL when a norm is 0."""
    return F.try_divide(dot_product(a, b), norm(a) * norm(b))
