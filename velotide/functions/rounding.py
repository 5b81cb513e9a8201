"""The two rounding rules prices are published under."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1: multiplying by it splits a double into a 26-bit head and the rest,
# so that both parts times a small power of ten are exact (Veltkamp split).
_SPLITTER = 134217729.0


def scaled_round(x: Column, digits: int) -> Column:
    """Multiply, round half to even, divide: the array-library rule."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def exact_round(x: Column, digits: int) -> Column:
    """Round the exact binary value half to even: the scalar rule.

    ``x * scale`` can land on a tie although ``x`` lies just below or above it
    (1.115 is stored as 1.11499...).  The rounding error of the product is
    recovered exactly and decides those cases.
    """
    scale = float(10**digits)
    product = x * scale
    head = x * _SPLITTER - (x * _SPLITTER - x)
    error = (head * scale - product) + (x - head) * scale
    below = F.floor(product)
    on_tie = (product - below) == 0.5
    return (
        F.when(on_tie & (error > 0), below + 1.0)
        .when(on_tie & (error < 0), below.cast("double"))
        .otherwise(F.rint(product))
        / scale
    )


def whole(x: Column) -> Column:
    """Nearest whole number, ties to even, as bigint."""
    return F.rint(x).cast("bigint")


def half_even_cents(x: Column) -> Column:
    """A two-decimal amount as whole cents; sums of these are exact and
    therefore independent of partitioning and row order."""
    return F.rint(x * 100.0).cast("bigint")
