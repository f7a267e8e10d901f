"""Whole flows on tiny tables."""

import datetime as dt

import pytest
from vitalgrid import params as P
from vitalgrid.plans import evaluation, features
from vitalgrid.plans.wide import RawTables, deidentify, display, wide_table

T0 = dt.datetime(2150, 3, 1, 8)
H = dt.timedelta(hours=1)


def raw(spark, spec):
    make = spark.createDataFrame
    code = spec.code_column
    versions = spec.code_version is not None
    codes = [(1, 11, "A1", 9), (1, 11, "A1", 9), (1, 11, "B2", 10), (1, 11, "ZZ", 9)]
    names = [("A1", 9, "first"), ("B2", 10, "second"), ("B2", 9, "old second")]
    if not versions:
        codes, names = [c[:3] for c in codes], [(c, n) for c, _, n in names if n != "old second"]
    code_schema = f"subject_id long, hadm_id long, {code} string" + (", icd_version int" if versions else "")
    name_schema = f"{code} string, " + ("icd_version int, " if versions else "") + "long_title string"
    temp = P.FAHRENHEIT_ITEMS[0]
    chart = [
        (1, 11, T0 + H, temp, 98.6, None), (1, 11, T0 + 2 * H, temp, 300.0, None),
        (1, 11, T0 + H, P.CAPILLARY_ITEMS[0], None, "normal <3 seconds"), (1, 11, T0 + H, P.HEART_ITEM, None, None),
        (1, 11, T0 + H, P.EYE_ITEM, 4.0, None), (1, 11, T0 + H, P.VERBAL_ITEM, 5.0, None), (1, 11, T0 + H, P.MOTOR_ITEM, 6.0, None),
        (1, 11, T0 + H, 198, 7.0, None), (1, None, T0 + H, P.HEART_ITEM, 99.0, None), (1, 11, T0 + 13 * H, P.HEART_ITEM, 80.0, None),
    ]
    return RawTables(
        patients=make(
            [(1, "M", T0.replace(year=2100), None, 60, 2148), (2, "F", T0.replace(year=1845), T0, None, 2148)],
            "subject_id long, gender string, dob timestamp_ntz, dod_hosp timestamp_ntz, anchor_age int, anchor_year int",
        ),
        admissions=make(
            [(1, 11, T0, T0 + 20 * H, None), (1, 12, T0 + 100 * H, T0 + 104 * H, T0 + 104 * H), (2, 21, T0, T0 + 5 * H, None), (2, 22, T0, T0, None)],
            "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, deathtime timestamp_ntz",
        ),
        chartevents=make(chart, "subject_id long, hadm_id long, charttime timestamp_ntz, itemid int, valuenum double, value string"),
        labevents=make([(1, 11, T0 + H, P.LAB_ITEMS["ph"], 7.4), (1, 11, T0 + H, 1, 5.0)], "subject_id long, hadm_id long, charttime timestamp_ntz, itemid int, valuenum double"),
        diagnoses=make(codes, code_schema), diagnosis_names=make(names, name_schema),
        procedures=make(codes[2:], code_schema), procedure_names=make(names, name_schema),
        prescriptions=make([(1, 11, "x"), (1, 11, None), (1, 11, "a")], "subject_id long, hadm_id long, drug string"),
    )


@pytest.mark.parametrize("spec", [P.III, P.IV], ids=["iii", "iv"])
def test_wide(spark, spec):
    wide = wide_table(raw(spark, spec), spec)
    got = {(r["visit"], r["record"]): r for r in wide.collect()}
    assert set(got) == {(11, 1), (11, 2), (12, 1), (21, 1)} and wide.columns == list(P.WIDE_NAMES)
    first, second, death, other = got[11, 1], got[11, 2], got[12, 1], got[21, 1]
    assert (first["los"], first["sex"], first["readmission"], death["readmission"]) == (0.83, 1, 1, 0)
    assert second["heart_rate"] == 80.0 and first["heart_rate"] is None and first["ph"] == 7.4
    if spec is P.III:
        # Out-of-range Fahrenheit is refused, the refill text is case sensitive, the total is its own item.
        assert (first["temperature"], first["capillary_normal"], first["gcs_total_7"], first["gcs_total_15"]) == (37.0, 0, 1, 0)
        assert (death["outcome"], other["outcome"], first["age"], other["age"]) == (0, 1, 50, 90)
        assert first["condition_codes"] == "A1;A1;B2" and first["condition_titles"] == "first;first;second"
        assert first["procedure_titles"] == "second"
    else:
        assert (first["temperature"], first["capillary_normal"], first["gcs_total_7"], first["gcs_total_15"]) == (148.89, 1, 0, 1)
        assert (death["outcome"], other["outcome"], first["age"], other["age"]) == (1, 0, 62, None)
        assert first["condition_codes"] == "A1;A1" and first["procedure_codes"] is None
    assert first["medications"] == "a;x" and second["medications"] is None
    shown = display(deidentify(wide))
    assert shown.columns == list(P.WIDE_NAMES.values())
    ids = {(r["PatientID"], r["VisitID"]) for r in shown.select("PatientID", "VisitID").collect()}
    assert len(ids) == 3 and all(10_001 <= p <= 10_002 for p, _ in ids) and {v for _, v in ids} == {1, 2}


def test_texts_and_gaps(spark, rows):
    wide = wide_table(raw(spark, P.III), P.III)
    texts = features.visit_texts(wide)
    splits = spark.createDataFrame([(1, "train"), (2, "test")], "patient long, split string")
    out = features.split_texts(texts, splits)
    assert rows(out, "visit", "gap_days", "medications", "split") == [
        (11, None, "a;x", "train"), (12, 3, None, "train"), (21, None, None, "test"),
    ]


def test_readmission_cohort(spark, rows):
    wide = wide_table(raw(spark, P.III), P.III)
    kept = features.cohort(wide, P.III, "readmission")
    # Patient 1 is cut after the last visit that leads to a readmission.
    assert rows(kept, "visit", "record") == [(11, 1), (11, 2), (21, 1)]
    with pytest.raises(ValueError):
        features.cohort(wide, P.III, "other")


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 0.5, 1, 2.0, 0, "train")], "patient long, visit long, record long, heart_rate double, outcome int, los double, readmission int, split string")
    assert features.feature_columns(df) == ["heart_rate"]


def test_evaluation(spark, rows):
    labels = spark.createDataFrame(
        [(1, 0.0, 0.0, 1, 0), (1, 1.0, 0.0, 1, 1), (1, 1.0, 1.0, 1, 0), (2, 1.0, 0.0, 0, 0), (3, 1.0, 0.0, 0, 0)],
        "patient long, visit_pos double, record_pos double, outcome int, readmission int",
    )
    assert rows(evaluation.labels_for_split(labels, "readmission")) == [(1, 1), (2, 0), (3, 0)]
    y = evaluation.labels_for_split(labels, "outcome")
    assert rows(y) == [(1, 1), (2, 0), (3, 0)]
    head = "# Prediction Result #\n"
    answers = spark.createDataFrame([(1, f"{head}1"), (2, f"{head}1"), (3, "none")], "patient long, answer string")
    model = spark.createDataFrame([(1, 0.9), (2, 0.2), (3, 0.1)], "patient long, p1 double")
    scored = evaluation.scored_labels(y, model, answers)
    assert rows(scored, "patient", "y", "p1", "p2") == [(1, 1, 0.9, 1.0), (2, 0, 0.2, 1.0), (3, 0, 0.1, 0.0)]
    out = evaluation.blended_test(scored, scored).first()
    assert out["auroc"] == 1.0 and out["auprc"] == 1.0 and round(out["min_ps"], 6) == 1.0
    with pytest.raises(Exception, match="not unique"):
        evaluation.scored_labels(y, model.union(model), answers).collect()


def test_whole_feature_flow_to_csv(spark, tmp_path):
    from dataclasses import replace

    from vitalgrid.sources.tables import csv_header

    spec = replace(P.III, cohort_outcome=4, outcome_share=0.5)
    records = features.cohort(wide_table(raw(spark, P.III), P.III), spec, "outcome")
    series = features.time_series(records, bound=spec.outcome_rows).persist()
    assert series.count() == 4 and len(series.columns) == 53
    settings = P.Settings(split_ratios=(0.5, 0.0))
    rows = features.scaled_splits(features.encoded(series, spec), spec, settings).persist()
    assert {r["split"] for r in rows.select("split").distinct().collect()} == {"train", "test"}
    folder = str(tmp_path / "splits")
    features.write_splits(rows, spec, folder)
    names = csv_header(spark, f"{folder}/train_features")
    assert names[:4] == ["PatientID", "VisitID", "RecordTime", "Sex"] and names[-1] == "D23" and len(names) == 71
    assert csv_header(spark, f"{folder}/test_labels") == ["PatientID", "VisitID", "Outcome", "LOS", "Readmission"]
    stored = spark.read.csv(f"{folder}/*_labels", header=True)
    assert stored.where("PatientID is not null").count() == 4
