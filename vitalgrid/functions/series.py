"""Array expressions for short series that are already stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def resample(series: Column, n: int) -> Column:
    """Linear resample of an array to ``n`` points.

    An empty or NULL array gives zeros, a single value gives a constant. The
    grid position of point i is i*(size-1)/(n-1), kept as whole and remainder
    so that it is exact.
    """
    if n < 1:
        raise ValueError("n must be positive")
    size = F.size(series)
    values = series.cast("array<double>")
    steps = max(n - 1, 1)

    def point(i: Column) -> Column:
        at = i.cast("long") * (size - 1)
        low = F.floor(at / F.lit(steps)).cast("int")
        rest = (at - low.cast("long") * steps) / F.lit(float(steps))
        high = F.least(low + 1, size - 1)
        return F.get(values, low) * (F.lit(1.0) - rest) + F.get(values, high) * rest

    return F.when(
        series.isNull() | (size == 0), F.array_repeat(F.lit(0.0), n)
    ).otherwise(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point))


def pad(rows: Column, width: int, length: Column) -> Column:
    """Extend an array of feature rows with zero rows up to ``length``."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    missing = F.greatest(length - F.size(rows), F.lit(0))
    return F.concat(rows, F.array_repeat(zero, missing))


def step_mask(size: Column, length: Column) -> Column:
    """True for real steps, False for padding."""
    return F.transform(F.sequence(F.lit(0), length - 1), lambda i: i < size)
