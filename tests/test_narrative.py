"""Lists, narratives, prompts and chat records."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators.inference import score_batches
from vitalgrid.operators.joins import rank_align
from vitalgrid.operators.lists import list_parts, top_items, top_pairs, visit_lists
from vitalgrid.operators.narrative import (
    PromptText, chat_record, context_within, drop_leaks, finetune_set, limit_tokens, patient_context, prompt,
    truth_block, visit_block,
)


TEXT = PromptText(
    system="Read the record.", user="# Task description #\n{task}\n\n# Patient EHR context #\n{context}\n\n# Reasoning #\n",
    tasks={"Outcome": "Predict death.", "Readmission": "Predict readmission.", "LOS": "Predict the stay."},
)


def test_lists(spark, rows):
    df = spark.createDataFrame(
        [(1, 3, "c", None), (1, 1, "a", "A"), (1, 2, "a", "A"), (2, 1, None, None)], "k long, seq int, code string, title string"
    )
    want = [(1, "a;a;c", "A;A"), (2, None, None)]
    for part_rows in (1, 2, 100):
        assert rows(visit_lists(df, ["k"], {"codes": "code", "titles": "title"}, ["seq"], part_rows=part_rows)) == want
    parts = list_parts(df, ["k"], {"codes": "code"}, ["seq"], part_size=2)
    assert rows(parts) == [(1, 0, "a;a"), (1, 1, "c"), (2, 0, None)]


def test_lists_in_text_order(spark, rows):
    words = [f"{a}{b}" for a in "zaéb" for b in ("", "x", "aa", "ab")] * 2
    df = spark.createDataFrame([(1, w) for w in words], "k long, w string")
    assert rows(visit_lists(df, ["k"], {"l": "w"}, ["w"])) == [(1, ";".join(sorted(words)))]


def test_top(spark, rows):
    df = spark.createDataFrame(
        [(1, "A; B;C", "a;b"), (2, "A;B ", "a;b;z"), (3, "B", "b"), (4, None, "b"), (5, "B", None)], "k long, t string, c string"
    )
    assert [tuple(r) for r in top_pairs(df, "t", "c", 10).collect()] == [("B", "b", 3), ("A", "a", 2)]
    assert [tuple(r) for r in top_items(df, "t", 2).collect()] == [("B", 4), ("A", 2)]


VISITS = "patient long, visit long, gap_days long, conditions string, medications string, procedures string"


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(1, 2, 5, "c2", None, "p2"), (1, 1, None, "c1", "m1", None), (2, 1, None, None, None, None)], VISITS)


def block(style="plain"):
    return visit_block(F.col("visit"), F.col("gap_days"), {c: F.col(c) for c in ("conditions", "medications", "procedures")}, style)


def test_context(texts, rows):
    got = dict(rows(patient_context(texts, "patient", ["visit"], block())))
    assert got[1] == (
        "Visit 1:\nConditions:  c1\nMedications: m1\nProcedures:  None\n\n"
        "Visit 2 (5 days after last Visit):\nConditions:  c2\nMedications: None\nProcedures:  p2"
    )
    assert got[2] == "Visit 1:\nConditions:  None\nMedications: None\nProcedures:  None"
    assert 'Visit 2 ("5" days after last Visit):' in dict(rows(patient_context(texts, "patient", ["visit"], block("quoted"))))[1]
    assert "Visit 2:\n" in dict(rows(patient_context(texts, "patient", ["visit"], block("none"))))[1]


def test_budget_keeps_what_the_cut_needs(spark, rows):
    data = [(p, v, None, f"c{v} x y", None, None) for p, n in ((1, 30), (2, 3), (3, 1)) for v in range(1, n + 1)]
    df = spark.createDataFrame(data, VISITS)
    for budget in (1, 9, 10, 26, 27, 100):
        whole = limit_tokens(patient_context(df, "patient", ["visit"], block()), "context", budget, "tail")
        kept = context_within(df, "patient", ["visit"], block(), budget, "tail")
        cut = limit_tokens(patient_context(kept, "patient", ["visit"], block()), "context", budget, "tail")
        assert rows(whole) == rows(cut)
    assert rows(context_within(df, "patient", ["visit"], block(), 30, "drop").select("patient").distinct()) == [(2,), (3,)]


def test_truth(spark, rows):
    df = spark.createDataFrame([(1, 1, 2, 1), (1, 1, 1, 0), (1, 2, 1, None)], "patient long, visit long, rec long, y int")
    assert rows(truth_block(df, "patient", "visit", ["rec"], "y")) == [(1, "Visit 1: 0\nVisit 2: NA")]


def test_prompt(texts):
    context = patient_context(texts, "patient", ["visit"], block())
    text = prompt(context, TEXT, "Readmission").where("patient = 2").first()["prompt"]
    assert text.startswith("[SYSTEM]\n") and "Predict readmission" in text and "Visit 1:" in text and "{context}" not in text
    with pytest.raises(ValueError):
        prompt(context, TEXT, "Other")


def test_own_tokenizer(spark, rows):
    class Letters:
        def encode(self, text):
            return list(text)

        def decode(self, ids):
            return "".join(ids)

    df = spark.createDataFrame([("abcdef",), ("xy",)], "t string")
    assert rows(limit_tokens(df, "t", 3, "drop", Letters())) == [("xy",)]
    assert rows(limit_tokens(df, "t", 3, "tail", Letters())) == [("def",), ("xy",)]


def test_leak_counts(spark):
    df = spark.createDataFrame([("ok",), ("it IS 0",), (None,), (" ",)], "t string")
    kept, seen = drop_leaks(df, "t")
    assert kept.count() == 1 and seen.get == {"kept": 1, "dropped": 3}


def test_chat_record(spark):
    df = spark.createDataFrame([(" why \n", 1)], "a string, y int")
    m = chat_record(df, F.lit("s"), F.lit("u"), F.col("a"), F.col("y")).first()["messages"]
    assert [(x["role"], x["content"]) for x in m] == [
        ("system", "s"), ("user", "u"), ("assistant", "why\n\n# Prediction Result #\n\n 1"),
    ]


def test_finetune_set(spark, texts, rows):
    labels = spark.createDataFrame(
        [(1, 0.0, 1, 0), (1, 0.0, 2, 1), (1, 1.0, 1, 1), (2, 1.0, 1, None)], "patient long, visit_pos double, record long, Outcome int"
    )
    answers = spark.createDataFrame([(1, "first"), (1, "again"), (2, "none"), (9, "other")], "patient long, answer string")
    out = finetune_set(texts, labels, answers, "Outcome", 2, 42, TEXT)
    # A repeated answer repeats the record; a patient without a last label is left out.
    assert rows(out, "patient", "label") == [(1, 1), (1, 1)]
    with pytest.raises(Exception, match="fewer ids"):
        finetune_set(texts, labels, answers, "Outcome", 3, 42, TEXT)


def test_rank_align_refuses_repeated_ranks(spark, rows):
    left = spark.createDataFrame([(1, 10), (1, 20)], "k long, v long")
    right = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k long, visit_rank long, s string")
    assert rows(rank_align(left, right, "k", ["v"], None), "v", "s") == [(10, "a"), (20, "b")]
    with pytest.raises(Exception, match="not unique"):
        rank_align(left, right.union(right), "k", ["v"], None).collect()


def test_batches(spark, rows):
    def load():
        def score(batch):
            return batch.assign(n=len(batch))[["id", "n"]]

        return score

    df = spark.range(25).repartition(3)
    done = spark.createDataFrame([(0,), (1,)], "id long")
    out = score_batches(df, load, "id long, n long", 4, "id", done, tasks=2)
    got = rows(out)
    assert [g[0] for g in got] == list(range(2, 25)) and max(g[1] for g in got) <= 4


def test_baseline(spark):
    from vitalgrid.operators.inference import fit_baseline, score_baseline
    from vitalgrid.operators.metrics import auroc

    # An observation in the same session must not get into the way of the fit.
    kept, seen = drop_leaks(spark.createDataFrame([("ok",)], "t string"), "t")
    assert kept.count() == 1 and seen.get["kept"] == 1
    df = spark.range(400).selectExpr("id", "cast(id % 7 as double) as a", "cast(id % 3 as double) as b", "cast(id % 7 > 4 as double) as y")
    model = fit_baseline(df.where("id % 4 > 0"), df.where("id % 4 = 0"), ["a", "b"], "y", [{"regParam": 1.0}, {"regParam": 0.01}])
    scored = score_baseline(model, df, "id", "y")
    assert scored.count() == 400 and auroc(scored, "y", "p").first()["auroc"] > 0.99
