"""Raw hospital tables to the wide record table, and its de-identified form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid import params as P
from vitalgrid.functions.scalars import flag
from vitalgrid.functions.timing import as_time
from vitalgrid.operators.events import (
    events_in_windows, events_union, expand_onehot, max_converted, max_of, pivot_items, presence, select_items, sum_of_max,
)
from vitalgrid.operators.joins import assemble, code_version, join_dictionary, only_first_record, to_wide_names
from vitalgrid.operators.lists import visit_lists
from vitalgrid.operators.sampling import pseudonym_map
from vitalgrid.operators.sizes import group_sizes
from vitalgrid.operators.visits import time_grid, visit_facts, visit_ordinal
from vitalgrid.session import materialize

KEYS = ["patient", "visit"]


@dataclass(frozen=True)
class RawTables:
    patients: DataFrame
    admissions: DataFrame
    chartevents: DataFrame
    labevents: DataFrame
    diagnoses: DataFrame
    diagnosis_names: DataFrame
    procedures: DataFrame
    procedure_names: DataFrame
    prescriptions: DataFrame


def selected_events(raw: RawTables, spec: P.Variant) -> DataFrame:
    """Wanted chart and lab events in one narrow stream."""
    def narrow(df: DataFrame, *extra: str) -> DataFrame:
        return df.select(
            F.col("subject_id").alias("patient"), F.col("hadm_id").alias("visit"),
            as_time(F.col("charttime")).alias("time"), F.col("itemid").alias("item"),
            F.col("valuenum").cast("double").alias("num"), *[F.col(c).alias("txt") for c in extra],
        )

    chart = select_items(raw.chartevents, "itemid", spec.chart_items, ["valuenum", "value"])
    labs = raw.labevents.where(F.col("itemid").isin(list(P.LAB_ITEMS.values())))
    return events_union(narrow(chart, "value"), narrow(labs))


def measurements(spec: P.Variant) -> dict[str, Column]:
    """Aggregates that turn the events of one window into its columns."""
    item, num = F.col("item"), F.col("num")
    text = F.col("txt") if spec.text_case_sensitive else F.lower("txt")
    normal, slow = P.CAPILLARY_TEXT if spec.text_case_sensitive else [t.lower() for t in P.CAPILLARY_TEXT]
    refill = item.isin(list(P.CAPILLARY_ITEMS))
    one = lambda i: max_of("item", [i], "num")
    cols = {
        "weight": max_of("item", P.WEIGHT_ITEMS, "num"),
        "height": max_of("item", P.HEIGHT_ITEMS, "num"),
        "capillary_normal": presence(refill & (text == normal)),
        "capillary_slow": presence(refill & (text == slow)),
    }
    for prefix, number, names in (
        ("gcs_eye_", P.EYE_ITEM, P.EYE), ("gcs_verbal_", P.VERBAL_ITEM, P.VERBAL), ("gcs_motor_", P.MOTOR_ITEM, P.MOTOR),
    ):
        cols |= {f"{prefix}{k}": presence((item == number) & (num == k)) for k in names}
    if spec.gcs_total_item is not None:
        cols |= {f"gcs_total_{k}": presence((item == spec.gcs_total_item) & (num == k)) for k in P.TOTALS}
    else:
        cols["gcs_total"] = sum_of_max("item", "num", [P.EYE_ITEM, P.VERBAL_ITEM, P.MOTOR_ITEM])
    return cols | {
        "diastolic_bp": one(P.DIASTOLIC_ITEM),
        "systolic_bp": one(P.SYSTOLIC_ITEM),
        "mean_bp": one(P.MEAN_ITEM),
        "heart_rate": one(P.HEART_ITEM),
        "respiratory_rate": one(spec.respiration_item),
        "temperature": max_converted("item", "num", P.CELSIUS_ITEMS, P.FAHRENHEIT_ITEMS, spec.temperature_range),
        "oxygen_saturation": one(P.LAB_ITEMS["oxygen_saturation"]),
        "fio2": max_of("item", spec.fio2_items, "num"),
        "glucose": one(P.LAB_ITEMS["glucose"]),
        "ph": one(P.LAB_ITEMS["ph"]),
    }


def code_lists(codes: DataFrame, names: DataFrame, spec: P.Variant, prefix: str) -> DataFrame:
    """Joined code and title lists per visit, in code order."""
    on = [spec.code_column] + (["icd_version"] if spec.code_version is not None else [])
    if spec.code_version is not None:
        codes, names = code_version(codes, "icd_version", spec.code_version), code_version(names, "icd_version", spec.code_version)
    coded = codes.select(F.col("subject_id").alias("patient"), F.col("hadm_id").alias("visit"), *on)
    rows = join_dictionary(coded, names.select(*on, "long_title"), on).select(
        *KEYS, F.col(spec.code_column).alias("code"), F.col("long_title").alias("title")
    )
    # A code has one title: the codes alone tell how long the lists are.
    lists = {f"{prefix}_codes": "code", f"{prefix}_titles": "title"}
    return visit_lists(rows, KEYS, lists, ["code", "title"], sizes=group_sizes(coded, KEYS))


def wide_table(raw: RawTables, spec: P.Variant, hours: int = 12, readmission_days: int = 30) -> DataFrame:
    """One row per (patient, visit, record) with facts, measurements and text lists.

    Events are reduced to one row per window before they meet the grid, so the
    widest shuffle carries aggregated rows.
    """
    # One row per visit, for the grid and for the events.
    facts = materialize(visit_facts(raw.patients, raw.admissions, spec, readmission_days))
    drugs = raw.prescriptions.select(
        F.col("subject_id").alias("patient"), F.col("hadm_id").alias("visit"), "drug"
    )
    lists = [
        code_lists(raw.diagnoses, raw.diagnosis_names, spec, "condition"),
        visit_lists(drugs, KEYS, {"medications": "drug"}, ["drug"]),
        code_lists(raw.procedures, raw.procedure_names, spec, "procedure"),
    ]
    # The lists meet one row per visit, before the visit is spread over its records.
    grid = time_grid(assemble(facts, *lists, keys=KEYS), "admit", "discharge", hours)
    grid = only_first_record(grid, "record", list(P.TEXT_LISTS))
    placed = events_in_windows(facts, selected_events(raw, spec), KEYS, "admit", "discharge", "time", hours)
    measured = pivot_items(placed, [*KEYS, "record"], measurements(spec))
    if spec.gcs_total_item is None:
        measured = measured.withColumns(expand_onehot(F.col("gcs_total"), P.TOTALS, "gcs_total_")).drop("gcs_total")
    records = grid.join(measured, [*KEYS, "record"], "left")
    flags = [c for c in P.WIDE_NAMES if c.startswith(("capillary_", "gcs_"))]
    return records.withColumns({c: flag(F.col(c) == 1) for c in flags}).select(*P.WIDE_NAMES)


def deidentify(wide: DataFrame, seed: int = 42, offset: int = 10_000) -> DataFrame:
    """Replace patient ids by pseudonyms and visit ids by the visit's ordinal."""
    visits = visit_ordinal(wide.select("patient", "admit").distinct(), "patient", "admit", "_ordinal")
    ids = visits.join(pseudonym_map(wide, "patient", seed, offset, "_new"), "patient", "inner")
    numbered = wide.join(ids, ["patient", "admit"], "inner")
    renamed = {"patient": F.col("_new").alias("patient"), "visit": F.col("_ordinal").alias("visit")}
    return numbered.select(*[renamed.get(c, F.col(c)) for c in wide.columns])


def display(wide: DataFrame) -> DataFrame:
    """The wide table under its published column names."""
    return to_wide_names(wide, P.WIDE_NAMES)
