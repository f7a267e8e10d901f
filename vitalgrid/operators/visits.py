"""Visit facts: stay length, ages, readmission, gaps, ordinals and the record grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.functions.scalars import flag
from vitalgrid.functions.timing import US_PER_HOUR, age_anchor, age_birth, as_time, elapsed_micros, los_days, whole_days
from vitalgrid.operators.ordered import neighbour, ordinal
from vitalgrid.params import Variant


def join_admissions(patients: DataFrame, admissions: DataFrame, key: str) -> DataFrame:
    """Admissions with their patient's columns.

    Many admissions meet one patient, so an oversized patient is split on the
    admissions side by the adaptive skew join.
    """
    return admissions.join(patients, key, "inner")


def readmission(
    df: DataFrame, patient: str, visit: str, admit: str, discharge: str, days: int = 30, out: str = "readmission"
) -> DataFrame:
    """1 when the next admission is at most ``days`` after discharge.

    There is no lower bound: a stay that starts before this one ends counts.
    """
    nxt = neighbour(df, [patient], [admit, visit], {"_next": admit}, "lead")
    soon = F.col("_next") <= F.col(discharge) + F.make_interval(days=F.lit(days))
    return nxt.withColumn(out, flag(soon)).drop("_next")


def gap_days(
    df: DataFrame, patient: str, visit: str, admit: str, discharge: str, out: str = "gap_days"
) -> DataFrame:
    """Whole days since the previous discharge, rounded down; NULL for the first visit."""
    prev = neighbour(df, [patient], [admit, visit], {"_prev": discharge}, "lag")
    return prev.withColumn(out, whole_days(F.col("_prev"), F.col(admit))).drop("_prev")


def visit_ordinal(df: DataFrame, patient: str, admit: str, out: str = "visit_id") -> DataFrame:
    """Number a patient's visits by admission time; equal times share a number.

    Distinct (patient, admission) pairs are ranked, not the record rows.
    """
    ranked = ordinal(df.select(patient, admit).distinct(), [patient], [admit], "row_number", out)
    return df.join(ranked, [patient, admit], "inner").select(*df.columns, out)


def n_windows(admit: Column, discharge: Column, hours: int) -> Column:
    """How many windows start from admission to one second before discharge; 0 if none."""
    span = elapsed_micros(admit, discharge) - F.lit(1_000_000)
    return F.when(span >= 0, F.floor(span / F.lit(float(hours * US_PER_HOUR))) + 1).otherwise(F.lit(0)).cast("long")


def window_start(admit: Column, record: Column, hours: int) -> Column:
    return as_time(admit) + F.make_interval(hours=((record - 1) * hours).cast("int"))


def time_grid(
    df: DataFrame, admit: str, discharge: str, hours: int = 12, record: str = "record", start: str = "record_start"
) -> DataFrame:
    """One row per fixed-length window of the stay, numbered from 1.

    The number comes from the sequence itself, so nothing is sorted. A stay
    without duration or without discharge has no window.
    """
    n = n_windows(F.col(admit), F.col(discharge), hours)
    grid = df.withColumn("_n", n).where(F.col("_n") > 0)
    grid = grid.withColumn(record, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n")
    return grid.withColumn(start, window_start(F.col(admit), F.col(record), hours))


def visit_facts(patients: DataFrame, admissions: DataFrame, spec: Variant, days: int = 30) -> DataFrame:
    """Patient and admission tables of a variant to one row per visit with labels and demographics."""
    death = F.col(spec.death_column).isNotNull()
    p_cols = [F.col("subject_id").alias("patient"), flag(F.lower("gender") == "m").alias("sex")]
    a_cols = [
        F.col("subject_id").alias("patient"),
        F.col("hadm_id").alias("visit"),
        as_time(F.col("admittime")).alias("admit"),
        as_time(F.col("dischtime")).alias("discharge"),
    ]
    (p_cols if spec.death_table == "patients" else a_cols).append(flag(death).alias("outcome"))
    if spec.age_rule == "birth":
        p_cols.append(as_time(F.col("dob")).alias("_dob"))
        age = age_birth(F.col("admit"), F.col("_dob"))
    else:
        p_cols += [F.col("anchor_age").alias("_anchor_age"), F.col("anchor_year").alias("_anchor_year")]
        age = age_anchor(F.col("admit"), F.col("_anchor_age"), F.col("_anchor_year"))
    joined = join_admissions(patients.select(*p_cols), admissions.select(*a_cols), "patient")
    facts = joined.withColumns({"age": age, "los": los_days(F.col("admit"), F.col("discharge"))})
    facts = readmission(facts, "patient", "visit", "admit", "discharge", days)
    return facts.select(
        "patient", "visit", "admit", "discharge", "outcome", "los", "readmission", "sex", "age"
    )
