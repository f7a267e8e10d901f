"""Patient narratives, prompts, chat records and answer filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F

from vitalgrid.functions.texts import LEAK, fill, is_leak, keep_last_words, strip, words
from vitalgrid.operators.joins import join_answers, keep_ids, rank_align
from vitalgrid.operators.lists import visit_lists
from vitalgrid.operators.ordered import first_row, last_row, prefix_sums
from vitalgrid.operators.sampling import sample_exact
from vitalgrid.session import materialize

# The line formats of a visit and of an answer.
HEADS = {
    "plain": (" (", " days after last Visit):"),
    "quoted": (' ("', '" days after last Visit):'),
}
LINES = (("Conditions:  ", "conditions"), ("Medications: ", "medications"), ("Procedures:  ", "procedures"))
RESULT_HEADING = "\n\n# Prediction Result #\n\n "


def visit_block(
    visit: Column, gap: Column | None, lists: Mapping[str, Column], gap_style: str = "plain", null_text: str = "None"
) -> Column:
    """Heading, three labelled lines and an empty line for one visit."""
    head = F.concat(F.lit("Visit "), visit.cast("long").cast("string"))
    if gap_style == "none" or gap is None:
        head = F.concat(head, F.lit(":"))
    else:
        before, after = HEADS[gap_style]
        days = F.concat(F.lit(before), gap.cast("long").cast("string"), F.lit(after))
        head = F.concat(head, F.coalesce(days, F.lit(":")))
    body = [F.concat(F.lit(label), F.coalesce(lists[name], F.lit(null_text))) for label, name in LINES]
    return F.concat_ws("\n", head, *body, F.lit(""))


def _joined(df: DataFrame, key: str, order: Sequence[str], text: Column, out: str) -> DataFrame:
    """Join a key's texts by line breaks, in order."""
    rows = df.withColumn("_t", text)
    return visit_lists(rows, [key], {out: "_t"}, list(order), sep="\n")


def patient_context(df: DataFrame, key: str, order: Sequence[str], block: Column, out: str = "context") -> DataFrame:
    """A patient's visit blocks in order, stripped: (key, context).

    The blocks of a patient with many visits are joined in parts by many tasks.
    Where a token budget applies use ``context_within`` first, which bounds what
    a patient can bring.
    """
    return _joined(df, key, order, block, out).withColumn(out, strip(F.col(out)))


def context_within(
    df: DataFrame, key: str, order: Sequence[str], block: Column, budget: int, mode: str
) -> DataFrame:
    """Limit the visit rows to what a budget of white-space tokens can use.

    ``drop`` removes patients above the budget; ``tail`` keeps the last visits
    that the budget reaches into, so that what is left out always lies before
    the cut that ``limit_tokens`` makes. Token
    counts are running sums, so no text is built for what is not used.
    """
    rows = df.withColumn("_w", F.size(words(block)).cast("long"))
    if mode == "drop":
        over = rows.groupBy(key).agg(F.sum("_w").alias("_all")).where(F.col("_all") > budget)
        return df.join(over, key, "left_anti")
    if mode != "tail":
        raise ValueError(f"unknown mode {mode!r}")
    summed = prefix_sums(rows, [key], list(order), {"_before": F.col("_w")}, totals=["_before"])
    after = F.col("_before_total") - F.col("_before") - F.col("_w")
    return summed.where(after <= budget).select(*df.columns)


def truth_block(
    df: DataFrame, key: str, visit: str, order: Sequence[str], label: str, out: str = "truth"
) -> DataFrame:
    """One line ``Visit k: y`` per distinct visit, NA where the label is missing."""
    firsts = first_row(df.select(*dict.fromkeys([key, visit, *order, label])), [key, visit], order)
    line = F.concat(
        F.lit("Visit "), F.col(visit).cast("long").cast("string"), F.lit(": "),
        F.coalesce(F.col(label).cast("int").cast("string"), F.lit("NA")),
    )
    return _joined(firsts, key, [visit], line, out)


@dataclass(frozen=True)
class PromptText:
    """Caller's texts. ``user`` may use {task}, {context} and {truth}."""

    system: str
    user: str
    tasks: Mapping[str, str]

    def task(self, name: str) -> str:
        if name not in self.tasks:
            raise ValueError(f"unknown task {name!r}")
        return self.tasks[name].strip()


def prompt(
    df: DataFrame, text: PromptText, task: str, context: str = "context", truth: str | None = None, out: str = "prompt"
) -> DataFrame:
    """System text, filled user text and their one-string form, the task text chosen by task."""
    slots = {"task": F.lit(text.task(task)), "context": F.col(context)}
    if truth is not None:
        slots["truth"] = F.col(truth)
    user = strip(fill(text.user, slots))
    system = F.lit(text.system.strip())
    return df.withColumn(out, F.concat(F.lit("[SYSTEM]\n"), system, F.lit("\n\n[USER]\n"), user, F.lit("\n")))


def limit_tokens(df: DataFrame, col: str, n: int, mode: str, tokenizer=None) -> DataFrame:
    """Drop prompts above ``n`` tokens, or keep each prompt's last ``n``.

    Tokens are separated by white space unless the caller brings a tokenizer
    with ``encode`` and ``decode``; that one runs in Arrow batches.
    """
    if mode not in ("drop", "tail"):
        raise ValueError(f"unknown mode {mode!r}")
    if tokenizer is None:
        if mode == "drop":
            return df.where(F.size(words(F.col(col))) <= n)
        return df.withColumn(col, keep_last_words(F.col(col), n))

    if mode == "drop":

        @F.pandas_udf("int")
        def n_tokens(s: pd.Series) -> pd.Series:
            return s.map(lambda t: len(tokenizer.encode(t)))

        return df.where(n_tokens(col) <= n)

    @F.pandas_udf("string")
    def tail(s: pd.Series) -> pd.Series:
        return s.map(lambda t: tokenizer.decode(tokenizer.encode(t)[-n:]))

    return df.withColumn(col, tail(col))


def drop_leaks(df: DataFrame, text: str, pattern: str = LEAK) -> tuple[DataFrame, Observation]:
    """Remove missing, blank or label-revealing texts.

    The observation holds ``kept`` and ``dropped`` after the first action.
    """
    leak = is_leak(F.col(text), pattern)
    seen = Observation()
    marked = df.withColumn("_leak", leak).observe(
        seen, F.count_if(~F.col("_leak")).alias("kept"), F.count_if(F.col("_leak")).alias("dropped")
    )
    return marked.where(~F.col("_leak")).drop("_leak"), seen


def chat_record(df: DataFrame, system: Column, user: Column, answer: Column, label: Column, out: str = "messages") -> DataFrame:
    """System, user and assistant messages; the assistant text ends with the result heading and label."""
    closing = F.concat(strip(answer), F.lit(RESULT_HEADING), label.cast("int").cast("string"))
    turns = [("system", system), ("user", user), ("assistant", closing)]
    return df.withColumn(out, F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns]))


def finetune_set(
    texts: DataFrame, labels: DataFrame, answers: DataFrame, task: str, n: int, seed: int, text: PromptText
) -> DataFrame:
    """Chat records for ``n`` sampled patients: (patient, label, messages).

    ``texts`` has (patient, visit, gap_days, conditions, medications,
    procedures), ``labels`` one row per record with (patient, visit_pos, record,
    <task>), ``answers`` (patient, answer). Labels meet visits by the visit's
    rank in the patient; the last visit decides the label, and a patient whose
    last visit has none is left out.
    """
    # Sample first, on ids alone: everything below works on the sampled patients only.
    answered = keep_ids(texts.select("patient").distinct(), answers, "patient")
    chosen = materialize(sample_exact(answered, "patient", n, seed))
    texts, labels, answers = (keep_ids(df, chosen, "patient") for df in (texts, labels, answers))

    if task in ("Outcome", "Readmission"):
        per_visit = first_row(
            labels.select("patient", "visit_pos", "record", task), ["patient", "visit_pos"], ["record"]
        ).drop("record")
    else:
        per_visit = labels.groupBy("patient", "visit_pos").agg(F.avg(task).alias(task))
    # Read for the contexts, their sizes and the last visits; bounded by the sample.
    data = materialize(rank_align(texts, per_visit, "patient", ["visit"], ["visit_pos"]))

    block = visit_block(F.col("visit"), F.col("gap_days"), {name: F.col(name) for _, name in LINES})
    context = patient_context(data, "patient", ["visit_rank"], block)
    last = last_row(data.select("patient", "visit_rank", task), ["patient"], ["visit_rank"])
    last = last.where(F.col(task).isNotNull()).select("patient", F.col(task).cast("int").alias("label"))
    merged = join_answers(context.join(last, "patient", "inner"), answers.select("patient", "answer"), "patient")
    user = strip(fill(text.user, {"task": F.lit(text.task(task)), "context": F.col("context")}))
    record = chat_record(merged, F.lit(text.system.strip()), user, F.col("answer"), F.col("label"))
    return record.select("patient", "label", "messages")
