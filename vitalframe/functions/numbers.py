"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Round the scaled value to the nearest even integer, as array libraries do."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)
