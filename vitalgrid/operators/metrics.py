"""Exact ranking and threshold metrics.

Rows are first collapsed to one row per distinct score with its counts of
positives and negatives. Running counts over the distinct scores use parts of about equal
size, cut at the scores' own quantiles (``prefix_sums``), so no task sees all scores, whether they are
probabilities, logits or crowded around one value. ``by`` groups, such as the blending weights of a
grid, are handled in the same pass. Rows without a score (NULL or NaN) are not ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.operators.ordered import prefix_sums

# Fixed value: keeps a ratio with an empty denominator at 0.
EPSILON = 1e-12


def linspace(start: float, stop: float, n: int) -> list[float]:
    """n evenly spaced numbers, both ends included."""
    step = (stop - start) / (n - 1)
    return [start + i * step for i in range(n - 1)] + [stop]


def score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: (by, p, pos, neg)."""
    score = F.col(p).cast("double")
    # Adding zero makes both zeros one score.
    return df.where(score.isNotNull() & ~F.isnan(score)).groupBy(*by, (score + F.lit(0.0)).alias("p")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


def _ranked(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    measures = {"pos_below": F.col("pos"), "neg_below": F.col("neg")}
    return prefix_sums(counts, list(by), ["p"], measures, totals=list(measures), hot_rows=None)


def ranking_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUROC (ties averaged) and average precision per group; NULL when a class is missing."""
    by = list(by)
    ranked = _ranked(counts, by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("pos_below_total").cast("double"), F.col("neg_below_total").cast("double")
    pos_above = all_pos - F.col("pos_below") - pos
    flagged_pos = all_pos - F.col("pos_below")
    flagged = flagged_pos + all_neg - F.col("neg_below")
    agg = [
        F.sum(neg * (pos_above + pos / 2.0)).alias("_wins"),
        F.sum(pos * flagged_pos / F.nullif(flagged, F.lit(0.0))).alias("_ap"),
        F.max(all_pos).alias("_p"),
        F.max(all_neg).alias("_n"),
    ]
    out = ranked.groupBy(*by).agg(*agg) if by else ranked.agg(*agg)
    return out.select(
        *by,
        F.try_divide("_wins", F.col("_p") * F.col("_n")).alias("auroc"),
        F.try_divide("_ap", F.col("_p")).alias("auprc"),
    )


def auroc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_from_counts(score_counts(df, y, p, by), by).select(*by, "auroc")


def auprc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return ranking_from_counts(score_counts(df, y, p, by), by).select(*by, "auprc")


def _ratio(num: Column, den: Column, eps: float | None) -> Column:
    if eps is None:
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    return num.cast("double") / (den.cast("double") + F.lit(eps))


def with_rates(counts: DataFrame, eps: float | None = None) -> DataFrame:
    """Precision, recall and the smaller of the two from tp, fp, fn.

    Without ``eps`` an empty denominator gives 0; with it, it is added.
    """
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = counts.withColumns({"precision": _ratio(tp, tp + fp, eps), "recall": _ratio(tp, tp + fn, eps)})
    return out.withColumn("min_ps", F.least("precision", "recall"))


def confusion(df: DataFrame, y: str, p: str, t: Column | float, eps: float | None = None) -> DataFrame:
    """One row of counts and rates at a threshold; a score equal to it is positive."""
    hit = F.col(p) >= (t if isinstance(t, Column) else F.lit(float(t)))
    counts = df.agg(
        F.count_if(hit & (F.col(y) == 1)).alias("tp"),
        F.count_if(hit & (F.col(y) == 0)).alias("fp"),
        F.count_if(~hit & (F.col(y) == 1)).alias("fn"),
        F.count_if(~hit & (F.col(y) == 0)).alias("tn"),
    )
    return with_rates(counts, eps)


def f1(df: DataFrame, y: str, p: str, t: float = 0.5) -> DataFrame:
    """F1 and recall at a threshold; 0 when nothing is positive."""
    c = confusion(df, y, p, t)
    score = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"), None)
    return c.select(score.alias("f1"), "recall")


def logloss(df: DataFrame, y: str, p: str, eps: float = 1e-7) -> DataFrame:
    """Mean binary cross-entropy of probabilities kept inside [eps, 1-eps]."""
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-(F.col(y) * F.log(q) + (F.lit(1) - F.col(y)) * F.log(F.lit(1.0) - q))).alias("logloss"))


def regression_metrics(df: DataFrame, y: str, p: str, tol: float) -> DataFrame:
    """Mean absolute error, root mean squared error and the share within ``tol``."""
    d = F.col(y) - F.col(p)
    return df.agg(
        F.avg(F.abs(d)).alias("mae"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg((F.abs(d) <= tol).cast("int")).alias("within"),
    )


def pos_weight(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """1/mean - 1 per label; NULL when there is no positive."""
    return df.agg(*[(F.try_divide(F.lit(1.0), F.avg(c)) - 1).alias(f"weight_{c}") for c in labels])


def threshold_index(p: Column, first: float, last: float, n: int) -> Column:
    """How many of the ``n`` evenly spaced thresholds are at most the score.

    The place is computed, then corrected by comparing with the exact threshold
    values, so a score equal to a threshold counts as reaching it.
    """
    grid = F.array(*[F.lit(t) for t in linspace(first, last, n)])
    guess = F.floor((p - F.lit(first)) / F.lit((last - first) / (n - 1))).cast("int") + 1
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(n))
    up = F.when((guess < n) & (F.get(grid, guess) <= p), guess + 1).otherwise(guess)
    return F.when((up > 0) & (F.get(grid, up - 1) > p), up - 1).otherwise(up)


def threshold_table(
    counts: DataFrame, first: float, last: float, n: int, by: Sequence[str] = (), eps: float | None = None
) -> DataFrame:
    """Counts and rates at every threshold of an even grid: (by, t_no, t, tp, fp, fn, ...).

    ``counts`` is ``score_counts``. Scores fall into the n+1 gaps of the grid by
    one aggregation; the sums above a threshold then run over those gaps only.
    Rows are never repeated per threshold.
    """
    by = list(by)
    gaps = (
        counts.groupBy(*by, threshold_index(F.col("p"), first, last, n).alias("g"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # One row per group with an (n+1)-long array of gap counts: bounded by the grid.
    packed = gaps.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("g", F.struct("pos", "neg")))).alias("m"),
        F.sum("pos").alias("_pos"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"))
    at = lambda k: F.coalesce(F.try_element_at("m", k), zero)
    ts = F.array(*[F.lit(t) for t in linspace(first, last, n)])
    long_form = packed.select(*by, "_pos", "m", F.posexplode(ts).alias("t_no", "t"))
    cell = at(F.col("t_no") + 1)
    long_form = long_form.withColumns({"_cp": cell["pos"], "_cn": cell["neg"]}).drop("m")
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    above = group.orderBy("t_no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    tp = F.sum("_cp").over(above)
    table = long_form.withColumns({"tp": tp, "fp": F.sum("_cn").over(above), "fn": F.col("_pos") - tp})
    return with_rates(table.drop("_pos", "_cp", "_cn"), eps)


def best_threshold(table: DataFrame, metric: str) -> DataFrame:
    """The first threshold with the highest value of a rate: (t, value)."""
    return table.orderBy(F.desc(metric), "t").limit(1).select("t", F.col(metric).alias("value"))
