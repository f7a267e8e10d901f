"""Answers and sequence scores to blended test metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitalgrid.functions.texts import answer_label, truncate_answer
from vitalgrid.operators.ensemble import evaluate, grid_search
from vitalgrid.operators.joins import pair_scores
from vitalgrid.operators.ordered import first_row, last_visit_first_row


def labels_for_split(labels: DataFrame, task: str) -> DataFrame:
    """(patient, y): the first record, or the last visit's first record for readmission."""
    if task == "outcome":
        rows = first_row(labels, ["patient"], ["visit_pos", "record_pos"])
    elif task == "readmission":
        rows = last_visit_first_row(labels, "patient", "visit_pos", ["record_pos"])
    else:
        raise ValueError(f"unknown task {task!r}")
    return rows.select("patient", F.col(task).cast("int").alias("y"))


def answer_scores(answers: DataFrame, strict: bool = True) -> DataFrame:
    """(patient, p2): the hard label of each truncated answer as a score."""
    text = truncate_answer(F.col("answer"), strict)
    return answers.select("patient", answer_label(text, strict).cast("double").alias("p2"))


def scored_labels(labels: DataFrame, sequence_scores: DataFrame, answers: DataFrame) -> DataFrame:
    """(patient, y, p1, p2), matched by patient."""
    return labels.join(pair_scores(sequence_scores, answer_scores(answers), "patient"), "patient", "inner")


def blended_test(val: DataFrame, test: DataFrame) -> DataFrame:
    """Weight and threshold from validation, measures on test; one row.

    Both frames have (y, p1, p2).
    """
    best = grid_search(val, "y", "p1", "p2").first()
    if best["alpha"] is None:
        raise ValueError("validation has no usable scores")
    fixed = {"alpha": F.lit(best["alpha"]), "t": F.lit(best["t"])}
    return evaluate(test, "y", "p1", "p2", best["alpha"], best["t"]).withColumns(fixed)
