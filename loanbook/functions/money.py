"""Money helpers. Division by 100 happens here and nowhere else."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def units(cents: Column) -> Column:
    """Cents to units, as a double (true division, never truncating)."""
    return cents.cast("double") / F.lit(100.0)


def amount(value: Column) -> Column:
    """Money already in units, as a double."""
    return value.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or NULL when the divisor is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
