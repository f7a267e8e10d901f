"""Numeric and flag expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from vitalgrid.params import Band


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def guard(c: Column, lo: float, hi: float) -> Column:
    """The value inside [lo, hi], else NULL."""
    return F.when(c.between(lo, hi), c)


def f_to_c(c: Column) -> Column:
    """Fahrenheit to Celsius, rounded to two places."""
    return F.round((c - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0), 2)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def blend(p1: Column, p2: Column, alpha: Column | float) -> Column:
    """alpha * p1 + (1 - alpha) * p2."""
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return a * p1 + (F.lit(1.0) - a) * p2


def as_type(c: Column, kind: str, strict: bool = True) -> Column:
    """Cast; bad input is an error when strict, else NULL."""
    return c.cast(kind) if strict else c.try_cast(kind)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def band_score(c: Column, bands: Sequence[Band]) -> Column:
    """Score of the first closed band that holds the value.

    A ``None`` edge is open. A value in a gap, past the ends, or NULL scores NULL.
    """
    out: Column | None = None
    for lo, hi, score in bands:
        cond = F.lit(True)
        if lo is not None and hi is not None:
            cond = (c >= F.lit(lo)) & (c <= F.lit(hi))
        elif lo is not None:
            cond = c >= F.lit(lo)
        elif hi is not None:
            cond = c <= F.lit(hi)
        hit = c.isNotNull() & cond
        out = F.when(hit, F.lit(float(score))) if out is None else out.when(hit, F.lit(float(score)))
    if out is None:
        raise ValueError("no bands given")
    return out


def flag_score(normal: Column, abnormal: Column) -> Column:
    """0 for the first flag, 2 for the second, NULL when neither is set."""
    return F.when(normal == 1, F.lit(0.0)).when(abnormal == 1, F.lit(2.0))


def onehot_mean(flags: Mapping[int, Column]) -> Column:
    """Mean of the numbers whose flag is 1; NULL when no flag is set."""
    hits = {k: flag(c == 1) for k, c in flags.items()}
    total = reduce(add, (F.lit(k) * h for k, h in hits.items()))
    return F.try_divide(total.cast("double"), reduce(add, hits.values()).cast("double"))


def row_mean(cols: Sequence[Column], empty: float | None = 0.0) -> Column:
    """Mean across columns, NULLs skipped; ``empty`` when all are NULL."""
    total = reduce(add, (F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols))
    seen = reduce(add, (flag(c.isNotNull()) for c in cols))
    mean = F.try_divide(total, seen.cast("double"))
    return mean if empty is None else F.coalesce(mean, F.lit(float(empty)))


def block_score(gcs: Column, features: Column) -> Column:
    """(gcs * 4/15 + features) / 8, a missing part counted as 0."""
    g, f = F.coalesce(gcs, F.lit(0.0)), F.coalesce(features, F.lit(0.0))
    return (g * F.lit(4.0) / F.lit(15.0) + f) / F.lit(8.0)


def minmax_scale(c: Column, lo_stat: Column, hi_stat: Column, lo: float, hi: float) -> Column:
    """Scale by the fitted range.

    A constant or never-seen column is 1 throughout; a NULL is 0; a value
    outside [lo, hi] is 1; the result is not limited to [0, 1].
    """
    return (
        F.when(lo_stat.isNull() | hi_stat.isNull() | (hi_stat <= lo_stat), F.lit(1.0))
        .when(c.isNull(), F.lit(0.0))
        .when((c < lo) | (c > hi), F.lit(1.0))
        .otherwise((c - lo_stat) / (hi_stat - lo_stat))
    )
