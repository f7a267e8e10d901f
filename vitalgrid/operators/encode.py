"""Scaling to the training range, and model sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.functions.scalars import clip, minmax_scale
from vitalgrid.functions.series import pad, step_mask
from vitalgrid.operators.ordered import first_row, last_row, ordinal

SEGMENT = 4096


def min_max(df: DataFrame, cols: Sequence[str], limits: tuple[float, float] | None = None) -> DataFrame:
    """One row with ``min_<c>`` and ``max_<c>`` of every column, in one pass.

    With ``limits`` a value outside counts as the limit. A column the table does
    not have gives NULLs.
    """
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`").cast("double") if c in df.columns else F.lit(None).cast("double")
        v = clip(v, *limits) if limits else v
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return df.agg(*aggs)


def minmax_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str], limits: tuple[float, float]) -> DataFrame:
    """Scale columns by a one-row table of fitted ranges.

    The row enters the plan as one scalar subquery: no join and no fetch to the
    driver while the plan is built.
    """
    with_stats = df.withColumn("_s", stats.select(F.struct(*stats.columns)).scalar())
    s = F.col("_s")
    scaled = {
        c: minmax_scale(F.col(f"`{c}`").cast("double"), s[f"min_{c}"], s[f"max_{c}"], *limits) for c in cols
    }
    return with_stats.withColumns(scaled).drop("_s")


def _vector(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("float") for c in sorted(cols)])


def sequences(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Ordered float matrix per key: (key, length, steps). Feature columns go in sorted name order.

    A matrix is one value and so lies in one task; for keys too long for that
    there is ``sequence_segments``.
    """
    step = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], _vector(cols).alias("x"))
    # Rows are moved, not half-built lists: lists cannot be combined before the shuffle.
    packed = df.repartition(key).groupBy(key).agg(F.sort_array(F.collect_list(step)).alias("_steps"))
    return packed.select(key, F.size("_steps").alias("length"), F.col("_steps")["x"].alias("steps"))


def sequence_segments(
    df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], segment: int = SEGMENT
) -> DataFrame:
    """The same matrix in rows of ``segment`` steps: (key, segment, length, steps, total_length)."""
    numbered = ordinal(df, [key], list(order), out="_at", size="_n")
    numbered = numbered.withColumn("segment", F.floor((F.col("_at") - 1) / F.lit(segment)).cast("long"))
    step = F.struct(F.col("_at").alias("at"), _vector(cols).alias("x"))
    packed = numbered.repartition(key, "segment").groupBy(key, "segment").agg(
        F.sort_array(F.collect_list(step)).alias("_steps"), F.max("_n").alias("total_length")
    )
    return packed.select(
        key, "segment", F.size("_steps").alias("length"), F.col("_steps")["x"].alias("steps"), "total_length"
    )


def pad_mask(df: DataFrame, steps: str, width: int, length: int | None = None, batch: str | None = None) -> DataFrame:
    """Pad matrices to a common length with zero steps and add the mask of real steps.

    Without ``length`` the longest matrix decides, of the same ``batch`` if one is
    named, so that one long matrix does not widen all. One longer than
    ``length`` is an error, never cut.
    """
    if length is not None:
        df = df.withColumn("_len", F.lit(length))
    elif batch is None:
        df = df.withColumn("_len", df.agg(F.max(F.size(steps))).scalar())
    else:
        longest = df.groupBy(F.col(batch).alias("_batch")).agg(F.max(F.size(steps)).alias("_len"))
        df = df.join(longest, F.col(batch).eqNullSafe(F.col("_batch")), "left").drop("_batch")
    size = F.size(steps)
    fits = F.when(size <= F.col("_len"), size).otherwise(
        F.raise_error(F.concat(F.lit("longer than the padded length: "), size.cast("string"))).cast("int")
    )
    masked = df.withColumn("mask", step_mask(fits, F.col("_len")))
    # A second step: the mask must see the length before padding.
    return masked.withColumn(steps, pad(F.col(steps), width, F.col("_len"))).drop("_len")


def label_for_task(
    df: DataFrame, task: str, key: str, order: Sequence[str],
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """One label per key: first row, or last row for readmission; all three for multitask."""
    names = dict(labels or {"outcome": "Outcome", "readmission": "Readmission", "los": "LOS"})
    kind = task.lower()
    if kind not in (*names, "multitask"):
        raise ValueError(f"unknown task {task!r}")
    wanted = list(names.values()) if kind == "multitask" else [names[kind]]
    pick = last_row if kind == "readmission" else first_row
    rows = pick(df.select(key, *order, *[w for w in wanted if w not in order]), [key], order)
    return rows.select(key, *[F.col(w).cast("double").alias(w) for w in wanted])
