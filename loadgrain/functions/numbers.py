"""Rounding that agrees with the analytical SQL dialect the reports come from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: Column, digits: int) -> Column:
    """Round to ``digits`` places, halves away from zero, on the scaled double.

    ``F.round(col, digits)`` rounds the shortest decimal text instead, which
    gives another last digit for values such as 0.15 / 3.
    """
    scale = float(10**digits)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)


def int_half_even(col: Column) -> Column:
    """DOUBLE to INT with halves going to the even neighbour (a cast truncates)."""
    return F.rint(col).cast("int")
