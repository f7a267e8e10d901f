"""Abnormality scores over sliding blocks of several lengths, and their pooling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions.scalars import band_score, block_score, flag_score, onehot_mean, row_mean
from vitalgrid.operators.ordered import COUNT_STRIDE, block_windows
from vitalgrid.params import BANDS, Band, TOTALS

FULL = "full"


def score_columns(
    bands: Mapping[str, Sequence[Band]] = BANDS,
    capillary: tuple[str, str] | None = ("capillary_normal", "capillary_slow"),
    totals: Mapping[int, str] | None = None,
) -> tuple[dict[str, Column], Column]:
    """Feature score columns by name, and the coma score, from wide-table columns."""
    features = {f"score_{c}": band_score(F.col(c), b) for c, b in bands.items()}
    if capillary:
        features["score_capillary"] = flag_score(*[F.col(c) for c in capillary])
    names = totals if totals is not None else {k: f"gcs_total_{k}" for k in TOTALS}
    return features, onehot_mean({k: F.col(c) for k, c in names.items()})


def _series_offsets(size: Column, scales: Sequence[int | str]) -> list[Column]:
    """Where each scale starts in the visit's series, from 0."""
    offsets, at = [], F.lit(0).cast("long")
    for s in scales:
        offsets.append(at)
        at = at + (F.lit(1) if s == FULL else F.greatest(size - F.lit(s) + 1, F.lit(0)))
    return offsets + [at]


def multi_scale_scores(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    size: str,
    features: Sequence[str],
    gcs: str,
    scales: Sequence[int | str],
    stride: int = COUNT_STRIDE,
) -> DataFrame:
    """Block scores of each visit: (keys, scale_no, start, pos, n_scores, score).

    ``position`` and ``size`` are the record number and the visit's record count
    (see ``ordinal``). Scales are taken in order, starts ascending; ``pos`` is
    the place in the visit's series and ``n_scores`` its length. A scale longer
    than the visit is skipped; ``"full"`` is the whole visit. Column means come
    first, then the mean of those.

    All fixed scales share one window specification, so one exchange and one
    sort; the whole-visit score is an aggregation.
    """
    keys, features = list(keys), list(features)
    fixed = [(i, s) for i, s in enumerate(scales) if s != FULL]
    offsets = _series_offsets(F.col(size), scales)
    narrow = df.select(*keys, position, size, gcs, *features)
    parts = []
    if fixed:
        rows, group = block_windows(narrow, keys, position, max(s for _, s in fixed), stride)
        base = Window.partitionBy(*group).orderBy(position)
        scores = []
        means = {}
        for i, s in fixed:
            frame = base.rowsBetween(0, s - 1)
            means |= {f"_{i}_{c}": F.avg(c).over(frame) for c in [gcs, *features]}
            score = block_score(F.col(f"_{i}_{gcs}"), row_mean([F.col(f"_{i}_{c}") for c in features]))
            scores.append(
                F.struct(
                    F.lit(i).alias("scale_no"),
                    (offsets[i] + F.col(position) - 1).alias("pos"),
                    F.when(F.col(position) + F.lit(s - 1) <= F.col(size), score).alias("score"),
                )
            )
        blocks = rows.withColumns(means).where("_own").withColumn("_s", F.explode(F.array(*scores)))
        parts.append(
            blocks.where(F.col("_s.score").isNotNull()).select(
                *keys, "_s.scale_no", F.col(position).cast("long").alias("start"), "_s.pos",
                offsets[-1].alias("n_scores"), "_s.score",
            )
        )
    full = [i for i, s in enumerate(scales) if s == FULL]
    if full:
        whole = narrow.groupBy(*keys).agg(
            *[F.avg(c).alias(c) for c in [gcs, *features]], F.max(size).alias(size)
        )
        score = block_score(F.col(gcs), row_mean([F.col(c) for c in features]))
        for i in full:
            parts.append(
                whole.select(
                    *keys, F.lit(i).alias("scale_no"), F.lit(1).cast("long").alias("start"), offsets[i].alias("pos"),
                    offsets[-1].alias("n_scores"), score.alias("score"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pool_series(scores: DataFrame, keys: Sequence[str], n: int, prefix: str = "D") -> DataFrame:
    """Linear resample of each visit's series to ``n`` columns, straight from the score rows.

    Point i lies at i*(m-1)/(n-1) of a series of m scores. It is the sum of all
    scores weighted by their distance to that place, 1 - |distance| where that
    is positive: two neighbours at most. A sum is combined before the shuffle
    and no series is ever gathered into one row.
    """
    steps = max(n - 1, 1)
    span = F.col("n_scores") - 1

    def point(i: int) -> Column:
        gap = F.abs(span * F.lit(i) - F.col("pos") * F.lit(steps))
        weight = F.greatest(F.lit(steps) - gap, F.lit(0)) / F.lit(float(steps))
        return F.sum(F.col("score") * weight).alias(f"{prefix}{i}")

    return scores.groupBy(*keys).agg(*[point(i) for i in range(n)])


def pooled_scores(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    size: str,
    features: Sequence[str],
    gcs: str,
    scales: Sequence[int | str],
    n: int,
    prefix: str = "D",
) -> DataFrame:
    """Pooled score vector per visit; zeros for a visit that no scale fits."""
    scores = multi_scale_scores(df, keys, position, size, features, gcs, scales)
    pooled = pool_series(scores, keys, n, prefix)
    if FULL in scales:
        return pooled
    visits = df.select(*keys).distinct().join(pooled, list(keys), "left")
    return visits.select(*keys, *[F.coalesce(f"{prefix}{i}", F.lit(0.0)).alias(f"{prefix}{i}") for i in range(n)])
