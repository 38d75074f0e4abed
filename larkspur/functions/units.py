"""User functions of the sales reports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fahrenheit_to_celsius(f: Column) -> Column:
    # multiply before dividing: 5/9 has no exact decimal
    return ((f - 32) * 5 / 9).cast("decimal(35,4)")


def inch_to_millimeter(inch: Column) -> Column:
    return (inch * F.expr("25.4")).cast("decimal(35,4)")


def winsorize(value: Column, upper, lower) -> Column:
    """Clamp into [lower, upper]."""
    return F.least(F.greatest(value, F.lit(lower)), F.lit(upper))


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero, with the same bits on every engine."""
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)).cast("double") / scale
