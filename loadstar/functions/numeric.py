"""Small numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division, NULL where the divisor is zero."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def rounded(value: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the double itself.

    ``F.round(x, n)`` goes through the decimal text of ``x``; scaling first
    rounds the binary value, which is what most SQL engines do.
    """
    value = as_col(value).cast("double")
    if digits == 0:
        return F.round(value)
    scale = float(10**digits)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def half_even(value: Column | str, digits: int) -> Column:
    """Round the scaled double to the nearest even: the numpy convention."""
    scale = F.lit(float(10**digits))
    return F.rint(as_col(value).cast("double") * scale) / scale


def percent(value: Column | str, digits: int = 1) -> Column:
    return rounded(as_col(value) * F.lit(100.0), digits)


def settled(value: Column | str, digits: int = 9) -> Column:
    """Drop the last bits of a floating sum or average.

    The order in which tasks merge partial sums is not fixed; without this the
    same query could return values that differ in the last place between two
    runs, and a group lying exactly on a limit could come and go.
    """
    return rounded(value, digits)


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; a NULL value becomes ``low``."""
    return F.least(F.lit(high), F.greatest(F.lit(low), value))
