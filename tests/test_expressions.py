"""Scalar, array and text expressions."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid import params as P
from vitalgrid.functions.scalars import band_score, block_score, clip, flag_score, minmax_scale, onehot_mean, row_mean, sigmoid
from vitalgrid.functions.series import resample
from vitalgrid.functions.texts import (
    answer_label, fill, is_leak, keep_last_words, split_trim, strip, truncate_answer, zip_lists,
)
from vitalgrid.operators.encode import min_max, minmax_apply


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name, value, score",
    [
        ("diastolic_bp", 80.0, 0), ("diastolic_bp", 80.5, None), ("diastolic_bp", 81.0, 1), ("diastolic_bp", 39.0, 3),
        ("diastolic_bp", 39.5, None), ("diastolic_bp", -5.0, 3), ("diastolic_bp", 150.0, 3), ("diastolic_bp", 151.0, None),
        ("temperature", 36.05, None), ("temperature", 36.0, 1), ("temperature", 29.9, None), ("age", 64.0, 0),
        ("age", 64.5, None), ("age", 90.0, 3), ("ph", 7.345, None), ("ph", 7.35, 0), ("oxygen_saturation", 101.0, None),
        ("age", None, None),
    ],
)
def test_bands(spark, name, value, score):
    got = one(spark, band_score(F.lit(value).cast("double"), P.BANDS[name]))
    assert got == (None if score is None else float(score))


def test_flags_and_means(spark):
    assert one(spark, flag_score(F.lit(1), F.lit(1))) == 0.0
    assert one(spark, flag_score(F.lit(0), F.lit(1))) == 2.0
    assert one(spark, flag_score(F.lit(0), F.lit(0))) is None
    assert one(spark, onehot_mean({3: F.lit(1), 15: F.lit(1), 8: F.lit(0)})) == 9.0
    assert one(spark, onehot_mean({3: F.lit(0)})) is None
    null = F.lit(None).cast("double")
    assert one(spark, row_mean([F.lit(1.0), null, F.lit(3.0)])) == 2.0
    assert one(spark, row_mean([null, null])) == 0.0
    assert one(spark, block_score(F.lit(15.0), F.lit(4.0))) == 1.0
    assert one(spark, block_score(null, null)) == 0.0
    assert one(spark, clip(null, -1, 1)) is None and one(spark, clip(F.lit(9.0), -1, 1)) == 1.0
    assert one(spark, sigmoid(F.lit(0.0))) == 0.5


@pytest.mark.parametrize("n", [1, 2, 12, 24])
@pytest.mark.parametrize("size", [0, 1, 2, 3, 11, 24, 100])
def test_resample_matches_numpy(spark, n, size):
    rng = np.random.default_rng(size)
    series = rng.random(size).astype("float32")
    got = one(spark, resample(F.lit(series.tolist()).cast("array<float>") if size else F.array().cast("array<float>"), n))
    if size == 0:
        want = np.zeros(n)
    else:
        want = np.interp(np.linspace(0, 1, n), np.linspace(0, 1, size), series)
    assert np.allclose(got, want, atol=1e-6)


def test_minmax_rules(spark):
    s = lambda v, lo=0.0, hi=10.0: one(
        spark, minmax_scale(F.lit(v).cast("double"), F.lit(lo).cast("double"), F.lit(hi).cast("double"), -250, 250)
    )
    assert s(5.0) == 0.5 and s(20.0) == 2.0 and s(-10.0) == -1.0
    assert s(251.0) == 1.0 and s(-300.0) == 1.0 and s(None) == 0.0
    assert s(None, 3.0, 3.0) == 1.0 and s(5.0, 3.0, 3.0) == 1.0 and s(5.0, None, None) == 1.0


def test_fit_and_apply(spark, rows):
    train = spark.createDataFrame([(1.0, 4.0, None), (900.0, 4.0, None), (None, 4.0, None)], "a double, b double, c double")
    stats = min_max(train, ["a", "b", "c"], (-250, 250))
    assert stats.first().asDict() == {"min_a": 1.0, "max_a": 250.0, "min_b": 4.0, "max_b": 4.0, "min_c": None, "max_c": None}
    out = minmax_apply(spark.createDataFrame([(1.0, 4.0, 1.0), (None, None, None), (260.0, 1.0, 2.0)], "a double, b double, c double"), stats, ["a", "b", "c"], (-250, 250))
    assert rows(out) == [(0.0, 1.0, 1.0), (0.0, 1.0, 1.0), (1.0, 1.0, 1.0)]


HEAD = "# Prediction Result #"


@pytest.mark.parametrize(
    "text, strict, loose",
    [
        ("no heading 1", 0, 0), (f"{HEAD}\n1", 1, 1), ("#prediction   result#\r\n\r\n 1 tail", 1, 1), (f"{HEAD} 1", 0, 1),
        (f"{HEAD}\n0 {HEAD}\n1", 0, 0), (f"{HEAD}\n\n 7", 0, 0), ("", 0, 0),
    ],
)
def test_answer_label(spark, text, strict, loose):
    assert one(spark, answer_label(F.lit(text))) == strict
    assert one(spark, answer_label(F.lit(text), strict=False)) == loose


def test_truncate_answer(spark):
    assert one(spark, truncate_answer(F.lit(f" a\n{HEAD}\n\n1 \t\nrest {HEAD}\n0"))) == f" a\n{HEAD}\n\n1 \t\n"
    assert one(spark, truncate_answer(F.lit("  none \n"))) == "none"
    assert one(spark, truncate_answer(F.lit(f"x {HEAD} 1 rest"))) == f"x {HEAD} 1 rest"
    assert one(spark, truncate_answer(F.lit(f"x {HEAD} 1 rest"), strict=False)) == f"x {HEAD} 1 "


@pytest.mark.parametrize(
    "text, leak",
    [(None, True), ("", True), (" \n\t", True), (" ", True), ("outcome IS 1", True), ("there is 10 of", True), ("is  1", False), ("this0", False), ("fine", False)],
)
def test_leaks(spark, text, leak):
    assert one(spark, is_leak(F.lit(text).cast("string"))) == leak


def test_text_helpers(spark):
    assert one(spark, strip(F.lit("\t  a b\n\r"))) == "a b"
    assert one(spark, fill("{b}-{a}-{c}", {"a": F.lit("{b}"), "b": F.lit("x")})) == "x-{b}-{c}"
    assert one(spark, split_trim(F.lit(" a ;b\t;;c"))) == ["a", "b", "", "c"]
    pairs = one(spark, zip_lists(F.lit("a;b;c"), F.lit("1; 2")))
    assert [(p["a"], p["b"]) for p in pairs] == [("a", "1"), ("b", "2")]
    assert one(spark, keep_last_words(F.lit("a  b\nc"), 2)) == "b\nc"
    assert one(spark, keep_last_words(F.lit("a  b\nc"), 3)) == "a  b\nc"
    assert one(spark, keep_last_words(F.lit(" a\nb\nc d\n\n\te f \n"), 4)) == "c d\n\n\te f \n"


def test_wide_names():
    assert len(P.WIDE_NAMES) == 58 and len(set(P.WIDE_NAMES.values())) == 58
    assert P.variant("iv").scales == (3, 5, "full")
    with pytest.raises(ValueError):
        P.variant("v")


def test_padding(spark):
    from vitalgrid.operators.encode import label_for_task, pad_mask, sequence_segments, sequences

    df = spark.createDataFrame([(1, 2, 0.5, 2.0), (1, 1, 0.25, 1.0), (2, 1, 0.75, 3.0)], "k long, t long, b double, a double")
    seq = sequences(df, "k", ["t"], ["b", "a"])
    for length in (None, 2):
        got = {r["k"]: r for r in pad_mask(seq, "steps", 2, length).collect()}
        assert got[1]["steps"] == [[1.0, 0.25], [2.0, 0.5]] and got[1]["mask"] == [True, True]
        assert got[2]["steps"] == [[3.0, 0.75], [0.0, 0.0]] and got[2]["mask"] == [True, False]
    with pytest.raises(Exception, match="longer"):
        pad_mask(seq, "steps", 2, 1).collect()
    split = sequence_segments(df, "k", ["t"], ["a"], segment=1)
    assert sorted((r["k"], r["segment"], r["length"], r["total_length"]) for r in split.collect()) == [(1, 0, 1, 2), (1, 1, 1, 2), (2, 0, 1, 1)]
    labels = df.withColumns({"Outcome": F.col("t"), "Readmission": F.col("t"), "LOS": F.col("a")})
    pick = lambda task, c: {r["k"]: r[c] for r in label_for_task(labels, task, "k", ["t"]).collect()}
    assert pick("outcome", "Outcome") == {1: 1.0, 2: 1.0} and pick("readmission", "Readmission") == {1: 2.0, 2: 1.0}
    assert pick("multitask", "LOS") == {1: 1.0, 2: 3.0}
    with pytest.raises(ValueError):
        label_for_task(labels, "other", "k", ["t"])
