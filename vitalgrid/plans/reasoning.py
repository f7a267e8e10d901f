"""Visit texts and labels to a model's reasoning texts, resumable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from vitalgrid.operators.inference import Scorer, score_batches
from vitalgrid.operators.narrative import PromptText, context_within, drop_leaks, limit_tokens, patient_context, prompt, truth_block
from vitalgrid.sources.jsonlines import append_new


def reasoning_prompts(
    texts: DataFrame, labels: DataFrame, block: Column, text: PromptText, task: str, label: str, budget: int
) -> DataFrame:
    """(patient, prompt): context and true labels of each patient, none above the token budget.

    ``texts`` has one row per visit, ``labels`` rows (patient, visit, record, ``label``).
    A context that is too long alone is left out before its text is built.
    """
    kept = context_within(texts, "patient", ["visit"], block, budget, "drop")
    context = patient_context(kept, "patient", ["visit"], block)
    truth = truth_block(labels, "patient", "visit", ["record"], label)
    filled = prompt(context.join(truth, "patient", "left"), text, task, truth="truth")
    return limit_tokens(filled, "prompt", budget, "drop").select("patient", "prompt")


def reasoning(
    prompts: DataFrame, task: str, load: Callable[[], Scorer], path: str, batch_size: int, slices: int = 1,
    tasks: int | None = None,
) -> tuple[DataFrame, Observation]:
    """Score the prompts the output does not hold yet, append, and drop texts that reveal the label.

    ``load`` gives a scorer of (patient, prompt) frames that returns (patient, answer).
    The stored lines are (patient, task, answer). A slice is scored by ``tasks`` model copies, one per core of the
    session unless stated: a staged slice is a few files, and as many tasks would score it.
    """
    copies = tasks or prompts.sparkSession.sparkContext.defaultParallelism

    def score(df: DataFrame) -> DataFrame:
        answers = score_batches(df, load, "patient long, answer string", batch_size, tasks=copies)
        return answers.withColumn("task", F.lit(task))

    stored = append_new(prompts, path, "patient", ["patient", "task", "answer"], transform=score, slices=slices)
    return drop_leaks(stored, "answer")
