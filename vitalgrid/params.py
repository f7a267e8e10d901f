"""Parameters of the two source variants, score bands and column names."""

from __future__ import annotations

from dataclasses import dataclass

Band = tuple[float | None, float | None, int]

# ---------------------------------------------------------------------------
# Closed bands (low, high, score); None is an open end. The first
# band that holds the value wins.
AGE = [(None, 64, 0), (65, 74, 1), (75, 84, 2), (85, None, 3)]
DIASTOLIC = [(60, 80, 0), (50, 59, 1), (81, 90, 1), (40, 49, 2), (91, 100, 2), (None, 39, 3), (101, 150, 3)]
SYSTOLIC = [(100, 120, 0), (90, 99, 1), (121, 140, 1), (80, 89, 2), (141, 160, 2), (None, 79, 3), (161, 240, 3)]
MEAN_PRESSURE = [(70, 100, 0), (60, 69, 1), (101, 110, 1), (50, 59, 2), (111, 130, 2), (None, 49, 3), (131, 180, 3)]
HEART_RATE = [(60, 100, 0), (50, 59, 1), (101, 110, 1), (40, 49, 2), (111, 130, 2), (None, 39, 3), (131, 170, 3)]
RESPIRATION = [(15, 18, 0), (11, 14, 1), (19, 22, 1), (8, 10, 2), (23, 25, 2), (None, 7, 3), (26, 34, 3)]
TEMPERATURE = [
    (36.1, 37.2, 0), (35.5, 36.0, 1), (37.3, 38.0, 1), (34.0, 35.4, 2), (38.1, 39.5, 2), (30.0, 33.9, 3), (39.6, 45, 3),
]
OXYGEN = [(95, 100, 0), (92, 94, 1), (90, 91, 2), (None, 89, 3)]
INSPIRED_OXYGEN = [(21, 100, 0), (18, 20, 1), (15, 17, 2), (None, 14, 3)]
GLUCOSE = [(70, 100, 0), (60, 69, 1), (101, 140, 1), (50, 59, 2), (141, 180, 2), (None, 49, 3), (181, 220, 3)]
ACIDITY = [
    (7.35, 7.45, 0), (7.30, 7.34, 1), (7.46, 7.5, 1), (7.20, 7.29, 2), (7.51, 7.6, 2), (7.00, 7.19, 3), (7.61, 7.8, 3),
]
# ---------------------------------------------------------------------------

BANDS: dict[str, list[Band]] = {
    "age": AGE,
    "diastolic_bp": DIASTOLIC,
    "systolic_bp": SYSTOLIC,
    "mean_bp": MEAN_PRESSURE,
    "heart_rate": HEART_RATE,
    "respiratory_rate": RESPIRATION,
    "temperature": TEMPERATURE,
    "oxygen_saturation": OXYGEN,
    "fio2": INSPIRED_OXYGEN,
    "glucose": GLUCOSE,
    "ph": ACIDITY,
}

# Column names of the wide table, in table order.
IDS = {
    "patient": "PatientID",
    "visit": "VisitID",
    "record": "RecordTime",
    "record_start": "RecordTimestamp",
    "admit": "AdmissionTime",
    "discharge": "DischargeTime",
    "outcome": "Outcome",
    "los": "LOS",
    "readmission": "Readmission",
    "sex": "Sex",
    "age": "Age",
    "weight": "Weight",
    "height": "Height",
}
CAPILLARY = {
    "capillary_normal": "Capillary refill rate-> less than 3s",
    "capillary_slow": "Capillary refill rate-> greater than 3s",
}
EYE = {1: "1 No Response", 2: "2 To Pain", 3: "3 To speech", 4: "4 Spontaneously"}
VERBAL = {
    1: "1 No Response", 2: "2 Incomprehensible sounds", 3: "3 Inappropriate Words", 4: "4 Confused", 5: "5 Oriented",
}
MOTOR = {
    1: "1 No Response", 2: "2 Abnormal extension", 3: "3 Abnormal Flexion", 4: "4 Flex-withdraws",
    5: "5 Localizes Pain", 6: "6 Obeys Commands",
}
TOTALS = range(3, 16)
VITALS = {
    "diastolic_bp": "Diastolic blood pressure",
    "systolic_bp": "Systolic blood pressure",
    "mean_bp": "Mean blood pressure",
    "heart_rate": "Heart Rate",
    "respiratory_rate": "Respiratory rate",
    "temperature": "Temperature",
    "oxygen_saturation": "Oxygen saturation",
    "fio2": "Fraction inspired oxygen",
    "glucose": "Glucose",
    "ph": "PH",
}
TEXT_LISTS = {
    "condition_codes": "Conditions_ICD9",
    "condition_titles": "Conditions_Long",
    "medications": "Medications",
    "procedure_codes": "Procedures_ICD9",
    "procedure_titles": "Procedures_Long",
}
WIDE_NAMES: dict[str, str] = {
    **IDS,
    **CAPILLARY,
    **{f"gcs_eye_{k}": f"Glascow coma scale eye opening->{v}" for k, v in EYE.items()},
    **{f"gcs_verbal_{k}": f"Glascow coma scale verbal response->{v}" for k, v in VERBAL.items()},
    **{f"gcs_motor_{k}": f"Glascow coma scale motor response->{v}" for k, v in MOTOR.items()},
    **{f"gcs_total_{k}": f"Glascow coma scale total->{k}" for k in TOTALS},
    **VITALS,
    **TEXT_LISTS,
}

# Item numbers shared by both variants.
EYE_ITEM, VERBAL_ITEM, MOTOR_ITEM = 220739, 223900, 223901
WEIGHT_ITEMS, HEIGHT_ITEMS = (224639, 226512), (226730,)
CAPILLARY_ITEMS = (223951, 224308)
CELSIUS_ITEMS, FAHRENHEIT_ITEMS = (676, 223762), (678, 223761)
DIASTOLIC_ITEM, SYSTOLIC_ITEM, MEAN_ITEM, HEART_ITEM = 220051, 220050, 220052, 220045
LAB_ITEMS = {"oxygen_saturation": 50817, "glucose": 50809, "ph": 50820}
CAPILLARY_TEXT = ("Normal <3 Seconds", "Abnormal >3 Seconds")


@dataclass(frozen=True)
class Variant:
    """Everything in which the two source systems differ."""

    name: str
    death_column: str
    death_table: str
    age_rule: str
    respiration_item: int
    fio2_items: tuple[int, ...]
    gcs_total_item: int | None
    temperature_range: tuple[float, float] | None
    text_case_sensitive: bool
    code_column: str
    code_version: int | None
    scales: tuple[int | str, ...]
    pool_size: int
    outcome_rows: int
    readmission_rows: int
    readmission_min_rows: int
    cohort_outcome: int
    cohort_readmission: int
    outcome_share: float
    readmission_share: float
    backfill_outcome: bool

    @property
    def chart_items(self) -> list[int]:
        items = [
            *WEIGHT_ITEMS, *HEIGHT_ITEMS, *CAPILLARY_ITEMS, EYE_ITEM, VERBAL_ITEM, MOTOR_ITEM,
            DIASTOLIC_ITEM, SYSTOLIC_ITEM, MEAN_ITEM, HEART_ITEM, self.respiration_item,
            *CELSIUS_ITEMS, *FAHRENHEIT_ITEMS, *self.fio2_items,
        ]
        return items + ([self.gcs_total_item] if self.gcs_total_item is not None else [])


# Item numbers, limits and shares of the two source variants.
III = Variant(
    name="iii", death_column="dod_hosp", death_table="patients", age_rule="birth",
    respiration_item=220210, fio2_items=(3420, 2981), gcs_total_item=198,
    temperature_range=(30.0, 45.0), text_case_sensitive=True, code_column="icd9_code", code_version=None,
    scales=(5, 10, "full"), pool_size=24, outcome_rows=200, readmission_rows=200, readmission_min_rows=1,
    cohort_outcome=20_000, cohort_readmission=12_500, outcome_share=0.13, readmission_share=0.25,
    backfill_outcome=False,
)
IV = Variant(
    name="iv", death_column="deathtime", death_table="admissions", age_rule="anchor",
    respiration_item=224690, fio2_items=(229280,), gcs_total_item=None,
    temperature_range=None, text_case_sensitive=False, code_column="icd_code", code_version=9,
    scales=(3, 5, "full"), pool_size=12, outcome_rows=4, readmission_rows=200, readmission_min_rows=8,
    cohort_outcome=20_000, cohort_readmission=20_000, outcome_share=0.13, readmission_share=0.17,
    backfill_outcome=True,
)
VARIANTS = {v.name: v for v in (III, IV)}


def variant(name: str) -> Variant:
    if name not in VARIANTS:
        raise ValueError(f"unknown variant {name!r}, expected one of {sorted(VARIANTS)}")
    return VARIANTS[name]


TASKS = ("Outcome", "Readmission", "LOS")


@dataclass(frozen=True)
class Settings:
    """Run settings that do not depend on the variant. Fixed values are the source's."""

    seed: int = 42
    split_ratios: tuple[float, float] = (0.7, 0.1)
    clip: tuple[float, float] = (-250.0, 250.0)
    readmission_days: int = 30
