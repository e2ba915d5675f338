"""Ratios, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, places: int | None) -> Column:
    """Round a double to ``places``; ``None`` leaves it alone."""
    if places is None:
        return x
    scale = float(10**places)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def ratio(part: Column, whole: Column, places: int | None = None) -> Column:
    """``part / whole`` as a double, NULL where ``whole`` is 0."""
    return round_half_even(
        F.try_divide(part.cast("double"), whole.cast("double")), places
    )


def percentage(part: Column, whole: Column, places: int | None = None) -> Column:
    return round_half_even(ratio(part, whole) * F.lit(100.0), places)
