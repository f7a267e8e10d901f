"""Batch scoring with a caller's function, and a weighted baseline model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.functions.scalars import sigmoid
from vitalgrid.operators.joins import not_done
from vitalgrid.operators.metrics import pos_weight, ranking_from_counts, score_counts
from vitalgrid.session import materialize

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def score_batches(
    df: DataFrame,
    load: Callable[[], Scorer],
    schema: str,
    batch_size: int,
    key: str | None = None,
    done: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Run a caller's scorer over rows in batches of at most ``batch_size``.

    ``load`` is called once per worker task and returns the scorer, so a model
    is read once, not per batch. With ``done`` the keys of an earlier output
    are left out first. ``tasks`` spreads the rows over that many model copies.
    """
    todo = df if done is None else not_done(df, done, key)
    if tasks is not None:
        todo = todo.repartition(tasks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for frame in frames:
            scorer = scorer or load()
            for at in range(0, len(frame), batch_size):
                yield scorer(frame.iloc[at : at + batch_size])

    return todo.mapInPandas(run, schema)


@dataclass(frozen=True)
class Baseline:
    """A fitted linear risk model: small enough to travel inside a plan as constants."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def probability(self) -> Column:
        terms = (F.lit(b) * F.col(f"`{c}`").cast("double") for c, b in zip(self.features, self.coefficients))
        return sigmoid(reduce(add, terms, F.lit(self.intercept)))


def fit_baseline(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, grid: Sequence[Mapping[str, float]]
) -> Baseline:
    """Logistic regression with the positives weighted by 1/mean - 1.

    The fit is Spark's distributed one. One model per setting; the first one with the
    highest validation AUROC is kept. Both tables are computed once and stored, then
    read by every setting.
    """
    if not grid:
        raise ValueError("no setting given")
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x").transform(train).select("_x", label)
    assembled = materialize(assembled)
    val = materialize(val.select(*features, label))
    weight = pos_weight(assembled, [label]).first()[0]
    rows = assembled.withColumn("_w", F.when(F.col(label) == 1, F.lit(float(weight or 1.0))).otherwise(F.lit(1.0)))
    best, best_score = None, -1.0
    for setting in grid:
        fitted = LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_w", **setting).fit(rows)
        model = Baseline(tuple(features), tuple(float(b) for b in fitted.coefficients), float(fitted.intercept))
        found = ranking_from_counts(score_counts(score_baseline(model, val, label), label, "p")).first()["auroc"]
        if best is None or (found is not None and found > best_score):
            best, best_score = model, -1.0 if found is None else found
    return best


def score_baseline(model: Baseline, df: DataFrame, *keep: str) -> DataFrame:
    """Probability of the positive class as column ``p``, a plain column expression."""
    return df.select(*keep, model.probability().alias("p"))
