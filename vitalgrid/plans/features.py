"""Wide table to cohort, time series, scaled split features and split texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vitalgrid.operators.encode import min_max, minmax_apply
from vitalgrid.operators.joins import attach, filter_group_size, keep_ids, patient_label, split_frames, to_wide_names
from vitalgrid.operators.ordered import first_values, impute, position01, truncate_after_last
from vitalgrid.operators.sampling import split_labels, stratified_sample
from vitalgrid.operators.scoring import pooled_scores, score_columns
from vitalgrid.operators.visits import gap_days
from vitalgrid.params import TEXT_LISTS, VITALS, WIDE_NAMES, Settings, Variant
from vitalgrid.session import materialize
from vitalgrid.sources.tables import write_csv

KEYS = ["patient", "visit"]
PHYSICAL = ["age", "weight", "height", *VITALS]
LABELS = ["outcome", "los", "readmission"]


def cohort(wide: DataFrame, spec: Variant, task: str, settings: Settings = Settings()) -> DataFrame:
    """Sampled patients' records, limited per visit."""
    if task == "outcome":
        rows, label = wide, "outcome"
        total, share, backfill = spec.cohort_outcome, spec.outcome_share, spec.backfill_outcome
        limit = spec.outcome_rows
    elif task == "readmission":
        rows = filter_group_size(wide, ["patient"], spec.readmission_min_rows)
        rows, label = truncate_after_last(rows, "patient", "visit", "readmission"), "readmission"
        total, share, backfill = spec.cohort_readmission, spec.readmission_share, True
        limit = spec.readmission_rows
    else:
        raise ValueError(f"unknown task {task!r}")
    per_patient = materialize(rows.groupBy("patient").agg(F.max(label).alias("label")))
    chosen = stratified_sample(per_patient, "patient", "label", total, share, settings.seed, backfill)
    kept = keep_ids(rows, chosen, "patient")
    # Records are numbered from 1 without gaps, so the first n are a plain filter.
    return kept.where(F.col("record") <= limit)


def time_series(records: DataFrame, bound: int | None = None) -> DataFrame:
    """Records without the text lists, gaps of the measured columns filled inside each visit.

    Times, labels and flags are never NULL.
    """
    cols = [c for c in PHYSICAL if c in records.columns]
    return impute(records.drop(*TEXT_LISTS), KEYS, ["record"], cols, bound=bound)


def visit_texts(records: DataFrame) -> DataFrame:
    """One row per visit: times and the five text lists."""
    return first_values(records, KEYS, ["record"], ["admit", "discharge", *TEXT_LISTS])


def visit_table(series: DataFrame) -> DataFrame:
    """One row per visit: record count, patient-level outcome and the visit's place in the patient.

    Everything that depends on whole visits or patients is worked out here, on
    visit rows, and meets the records in one join. Only three columns of the
    records are read.
    """
    visits = materialize(
        series.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_records"), F.max("outcome").alias("outcome"))
    )
    return position01(patient_label(visits, "patient", "outcome"), ["patient"], ["visit"], "visit_pos")


def scored_visits(series: DataFrame, visits: DataFrame, spec: Variant) -> DataFrame:
    """Pooled abnormality vector per visit. Records are numbered from 1 without gaps."""
    features, gcs = score_columns()
    scored = series.select(*KEYS, "record", gcs.alias("score_gcs"), *[c.alias(n) for n, c in features.items()])
    sized = attach(scored, visits.select(*KEYS, "n_records"), KEYS)
    return pooled_scores(sized, KEYS, "record", "n_records", list(features), "score_gcs", spec.scales, spec.pool_size)


def encoded(series: DataFrame, spec: Variant) -> DataFrame:
    """Records with pooled vector, patient outcome, and visit and record positions.

    ``visit_pos`` is the visit's place in the patient and ``record_pos`` the
    record's place in the visit, both in [0, 1].
    """
    visits = visit_table(series)
    facts = materialize(attach(visits, scored_visits(series, visits, spec), KEYS))
    rows = attach(series.drop("record_start", "admit", "discharge", "outcome"), facts, KEYS)
    place = F.when(F.col("n_records") == 1, F.lit(1.0)).otherwise(
        (F.col("record") - 1) / F.nullif(F.col("n_records") - 1, F.lit(0))
    )
    return rows.withColumn("record_pos", place).drop("n_records")


def scaled_splits(rows: DataFrame, spec: Variant, settings: Settings = Settings()) -> DataFrame:
    """All records with their split, continuous columns scaled by the training range."""
    splits = split_labels(rows, "patient", settings.split_ratios, settings.seed)
    labelled = rows.join(splits, "patient", "inner")
    cols = ["visit_pos", "record_pos", *PHYSICAL, *[f"D{i}" for i in range(spec.pool_size)]]
    stats = min_max(labelled.where(F.col("split") == "train"), cols, settings.clip)
    return minmax_apply(labelled, stats, cols, settings.clip)


def split_texts(texts: DataFrame, splits: DataFrame) -> DataFrame:
    """Visit texts with the gap since the previous discharge and the patient's split."""
    gaps = gap_days(texts, "patient", "visit", "admit", "discharge")
    return gaps.join(splits, "patient", "inner").select(
        *KEYS, "gap_days", "condition_titles", "medications", "procedure_titles", "split"
    )


def feature_columns(rows: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    """Model inputs: everything but ids, labels and the split."""
    skip = {"patient", "visit", "record", "split", *LABELS, *drop}
    return [c for c in rows.columns if c not in skip]


def published(rows: DataFrame, spec: Variant) -> tuple[DataFrame, DataFrame]:
    """Feature and label tables under their published names, with the split.

    Both carry the visit's position as ``VisitID`` and one row per record.
    """
    ids = {"patient": "PatientID", "visit_pos": "VisitID"}
    kept = [c for c in WIDE_NAMES if c not in (*KEYS, "record", "record_start", "admit", "discharge", *LABELS, *TEXT_LISTS)]
    inputs = {**ids, "record_pos": "RecordTime", **{c: WIDE_NAMES[c] for c in kept}}
    inputs |= {f"D{i}": f"D{i}" for i in range(spec.pool_size)}
    labels = {**ids, **{c: WIDE_NAMES[c] for c in LABELS}}
    return to_wide_names(rows, {**inputs, "split": "split"}), to_wide_names(rows, {**labels, "split": "split"})


#: The published names of the visit texts.
TEXT_NAMES = {
    "patient": "PatientID", "visit": "VisitID", "gap_days": "GapTime", "condition_titles": "Conditions_Long",
    "medications": "Medications", "procedure_titles": "Procedures_Long",
}


def published_texts(texts: DataFrame) -> DataFrame:
    """``split_texts`` rows under their published names, with the split."""
    return to_wide_names(texts, {**TEXT_NAMES, "split": "split"})


def write_splits(rows: DataFrame, spec: Variant, folder: str, texts: DataFrame | None = None) -> None:
    """CSV folders ``<split>_features`` and ``<split>_labels``; floats with six places.

    With the ``split_texts`` rows also ``<split>_cmps``, the visit texts.
    """
    tables = dict(zip(("features", "labels"), published(rows, spec)))
    if texts is not None:
        tables["cmps"] = published_texts(texts)
    for kind, table in tables.items():
        for split, part in split_frames(table, "split").items():
            write_csv(part, f"{folder.rstrip('/')}/{split}_{kind}")
