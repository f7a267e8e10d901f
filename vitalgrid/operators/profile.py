"""Small descriptive reports. Every report is a chain of map-side-combined aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F



def distinct_counts(df: DataFrame, patient: str, visit: str) -> DataFrame:
    """One row: rows, patients, visits, and visits per patient."""
    per_visit = df.groupBy(patient, visit).agg(F.count(F.lit(1)).alias("_rows"))
    per_patient = per_visit.groupBy(patient).agg(F.count(F.lit(1)).alias("_visits"), F.sum("_rows").alias("_rows"))
    return per_patient.agg(
        F.sum("_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("patients"),
        F.sum("_visits").alias("visits"),
        F.avg("_visits").alias("visits_per_patient"),
    )


def nested_means(df: DataFrame, patient: str, visit: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row: mean over patients of the mean over visits of the visit's first value."""
    at = F.struct(*order)
    firsts = df.groupBy(patient, visit).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols], F.count(F.lit(1)).alias("_rows")
    )
    patients = firsts.groupBy(patient).agg(
        *[F.avg(c).alias(c) for c in cols], (F.sum("_rows") / F.count(F.lit(1))).alias("_per_visit")
    )
    return patients.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols], F.avg("_per_visit").alias("records_per_visit"))


def cohort_profile(
    df: DataFrame, patient: str, visit: str, order: Sequence[str], outcome: str, los: str, readmission: str
) -> DataFrame:
    """One row: patients, deaths, mortality, and nested means of stay, readmission and records."""
    at = F.struct(*order)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at))
    visits = df.groupBy(patient, visit).agg(
        F.max(outcome).alias("_out"), first(los).alias("_los"), first(readmission).alias("_re"),
        F.count(F.lit(1)).alias("_rows"),
    )
    patients = visits.groupBy(patient).agg(
        F.max("_out").alias("_out"), F.avg("_los").alias("_los"), F.avg("_re").alias("_re"),
        F.count(F.lit(1)).alias("_visits"), (F.sum("_rows") / F.count(F.lit(1))).alias("_records"),
    )
    total, dead = F.count(F.lit(1)), F.coalesce(F.sum("_out"), F.lit(0))
    return patients.agg(
        total.alias("patients"),
        dead.cast("long").alias("dead"),
        (total - dead).cast("long").alias("alive"),
        F.try_divide(dead.cast("double"), total).alias("mortality"),
        F.avg("_visits").alias("visits_per_patient"),
        F.avg("_records").alias("records_per_visit"),
        F.avg("_los").alias("mean_los"),
        F.avg("_re").alias("mean_readmission"),
    )


def task_balance(df: DataFrame, split: str, patient: str, visit: str, tasks: Sequence[str]) -> DataFrame:
    """Per split and task: positives, negatives and share on visit and patient level."""
    visits = df.groupBy(split, patient, visit).agg(
        *[F.max(t).alias(t) for t in tasks], F.count(F.lit(1)).alias("_rows")
    )
    count_if = lambda c: F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0)))
    per_patient = visits.groupBy(split, patient).agg(
        F.count(F.lit(1)).alias("_visits"),
        F.sum("_rows").alias("_rows"),
        *[F.max(t).alias(t) for t in tasks],
        *[count_if(F.col(t) > 0).alias(f"_vp_{t}") for t in tasks],
        *[count_if(F.col(t) == 0).alias(f"_vn_{t}") for t in tasks],
    )
    per_split = per_patient.groupBy(split).agg(
        F.sum("_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("patients"),
        (F.sum("_visits") / F.count(F.lit(1))).alias("visits_per_patient"),
        *[F.sum(f"_vp_{t}").alias(f"_vp_{t}") for t in tasks],
        *[F.sum(f"_vn_{t}").alias(f"_vn_{t}") for t in tasks],
        *[count_if(F.col(t) > 0).alias(f"_pp_{t}") for t in tasks],
        *[count_if(F.col(t) == 0).alias(f"_pn_{t}") for t in tasks],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("task"), F.col(f"_vp_{t}").alias("visit_pos"), F.col(f"_vn_{t}").alias("visit_neg"),
                F.col(f"_pp_{t}").alias("patient_pos"), F.col(f"_pn_{t}").alias("patient_neg"),
            )
            for t in tasks
        ]
    )
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(a) + F.col(b))
    return (
        per_split.select(split, "n_rows", "patients", "visits_per_patient", F.inline(rows))
        .withColumn("visit_share", share("visit_pos", "visit_neg"))
        .withColumn("patient_share", share("patient_pos", "patient_neg"))
    )


def deceased(df: DataFrame, patient: str, outcome: str) -> DataFrame:
    """Patients with a positive outcome on any row."""
    return df.groupBy(patient).agg(F.max(outcome).alias("_o")).where(F.col("_o") == 1).select(patient)


