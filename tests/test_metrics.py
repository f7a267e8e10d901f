"""Ranking metrics, thresholds and the blending grid."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import metrics as M
from vitalgrid.operators import ensemble
from vitalgrid.operators.ensemble import evaluate, grid_search, grid_table, pick_best


def frame(spark, data):
    return spark.createDataFrame(data, "y long, p double")


def direct_auroc(data):
    pos, neg = [p for y, p in data if y == 1], [p for y, p in data if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def direct_ap(data):
    n_pos, out, seen = sum(y for y, _ in data), 0.0, 0.0
    for t in sorted({p for _, p in data}, reverse=True):
        hit = [y for y, p in data if p >= t]
        recall = sum(hit) / n_pos
        out += (recall - seen) * sum(hit) / len(hit)
        seen = recall
    return out


@pytest.fixture(scope="module")
def scored():
    rng = random.Random(11)
    return [(int(rng.random() < 0.3), rng.choice([round(rng.random(), 2), rng.random() * 1e-9, 1 - rng.random() * 1e-9, 0.0, 1.0])) for _ in range(400)]


def test_ranking(spark, scored):
    got = M.ranking_from_counts(M.score_counts(frame(spark, scored), "y", "p")).first()
    assert np.isclose(got["auroc"], direct_auroc(scored)) and np.isclose(got["auprc"], direct_ap(scored))


def test_ranking_by_group(spark, scored):
    df = frame(spark, scored).withColumn("g", F.lit(1)).union(frame(spark, [(1, 0.2), (0, 0.1)]).withColumn("g", F.lit(2)))
    got = {r["g"]: r["auroc"] for r in M.auroc(df, "y", "p", ["g"]).collect()}
    assert np.isclose(got[1], direct_auroc(scored)) and got[2] == 1.0


def test_ties_and_single_class(spark):
    assert M.auroc(frame(spark, [(1, 0.5), (0, 0.5), (0, 0.5)]), "y", "p").first()["auroc"] == 0.5
    assert M.auroc(frame(spark, [(1, 0.5), (1, 0.7)]), "y", "p").first()["auroc"] is None
    assert M.auprc(frame(spark, [(0, 0.5)]), "y", "p").first()["auprc"] is None


def test_logits_outside_the_unit_range(spark):
    data = [(i % 2, float(i * i - 50)) for i in range(30)]
    assert np.isclose(M.auroc(frame(spark, data), "y", "p").first()["auroc"], direct_auroc(data))


@pytest.mark.parametrize("shape", ["logits", "crowded", "rounded", "huge"])
def test_parts_follow_the_scores(spark, shape):
    """Any range of scores gives parts of about equal size and the direct values."""
    from vitalgrid.operators.ordered import add_range_chunks

    rng = random.Random(2)
    value = {
        "logits": lambda: rng.gauss(0, 30), "crowded": lambda: 0.5 + rng.random() * 1e-9, "rounded": lambda: round(rng.random(), 3),
        "huge": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300),
    }[shape]
    data = [(int(rng.random() < 0.4), value()) for _ in range(4000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = M.score_counts(frame(spark, data), "y", "p")
        sizes = [r["count"] for r in add_range_chunks(counts, [], ["p"]).groupBy("_chunk").count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
        got = M.ranking_from_counts(counts).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert np.isclose(got["auroc"], fast_auroc(data)) and np.isclose(got["auprc"], direct_ap(data) if shape == "rounded" else fast_ap(data))


def fast_auroc(data):
    p, y = np.array([d[1] for d in data]), np.array([d[0] for d in data])
    values, inverse, count = np.unique(p, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def fast_ap(data):
    """Average precision of scores without ties."""
    y = np.array([d[0] for d in sorted(data, key=lambda d: -d[1])])
    return (np.cumsum(y) / np.arange(1, len(y) + 1))[y == 1].mean()


def test_rows_without_a_score_are_not_ranked(spark):
    data = [(1, 0.9), (0, 0.2), (1, None), (0, float("nan")), (1, -0.0), (0, 0.0)]
    got = M.ranking_from_counts(M.score_counts(frame(spark, data), "y", "p")).first()
    assert np.isclose(got["auroc"], (1 + 1 + 0 + 0.5) / 4)


def test_confusion_and_f1(spark):
    df = frame(spark, [(1, 0.5), (1, 0.4), (0, 0.5), (0, 0.1), (1, 0.9)])
    c = M.confusion(df, "y", "p", 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (2, 1, 1, 1) and np.isclose(c["min_ps"], 2 / 3)
    assert np.isclose(M.f1(df, "y", "p").first()["f1"], 2 / 3)
    none = M.confusion(df, "y", "p", 2.0).first()
    assert none["precision"] == 0.0 and none["min_ps"] == 0.0


@pytest.mark.parametrize("first, last, n", [(0.01, 0.99, 19), (0.05, 0.95, 19), (0.01, 0.99, 181)])
def test_threshold_table(spark, scored, first, last, n):
    # Scores that are equal to a threshold must count as reaching it.
    grid = np.linspace(first, last, n)
    data = scored + [(i % 2, float(t)) for i, t in enumerate(grid)]
    table = M.threshold_table(M.score_counts(frame(spark, data), "y", "p"), first, last, n).orderBy("t_no").collect()
    assert len(table) == n and np.array_equal([r["t"] for r in table], grid)
    for r, t in zip(table, grid):
        assert r["tp"] == sum(1 for y, p in data if y == 1 and p >= t)
        assert r["fp"] == sum(1 for y, p in data if y == 0 and p >= t)
        assert r["fn"] == sum(1 for y, p in data if y == 1 and p < t)


def test_first_threshold_wins(spark):
    table = M.threshold_table(M.score_counts(frame(spark, [(1, 0.9), (0, 0.1)]), "y", "p"), 0.05, 0.95, 19)
    best = M.best_threshold(table, "min_ps").first()
    assert np.isclose(best["t"], 0.15) and best["value"] == 1.0
    assert np.isclose(M.best_threshold(table, "recall").first()["t"], 0.05)


def direct_grid(rows, n_alpha, grid):
    y = [r[0] for r in rows]
    out = []
    for i, a in enumerate(np.linspace(0, 1, n_alpha)):
        mix = [a * p1 + (1 - a) * p2 for _, p1, p2 in rows]
        pairs = list(zip(y, mix))
        roc, ap = direct_auroc(pairs), direct_ap(pairs)
        for j, t in enumerate(grid):
            tp = sum(1 for yy, p in pairs if p >= t and yy)
            fp = sum(1 for yy, p in pairs if p >= t and not yy)
            out.append((i, j, a, t, roc, ap, min(tp / (tp + fp + 1e-12), tp / (sum(y) + 1e-12))))
    return out


def test_grid_and_choice(spark):
    rng = random.Random(2)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1), float(rng.random() < 0.5)) for _ in range(60)]
    df = spark.createDataFrame(rows, "y long, a double, b double")
    thresholds = (0.01, 0.99, 13)
    want = direct_grid(rows, 7, np.linspace(*thresholds))
    table = grid_table(df, "y", "a", "b", 7, thresholds)
    got = sorted(tuple(r) for r in table.select("a_no", "t_no", "alpha", "t", "auroc", "auprc", "min_ps").collect())
    assert np.allclose(np.array(got), np.array(want))
    best = None
    for p in want:
        if best is None:
            best = p
            continue
        close = lambda k: np.isclose(p[k], best[k])
        if p[4] > best[4] or (close(4) and p[5] > best[5]) or (close(4) and close(5) and p[6] > best[6]):
            best = p
    chosen = grid_search(df, "y", "a", "b", 7, thresholds).first()
    assert np.isclose(chosen["alpha"], best[2]) and np.isclose(chosen["t"], best[3])
    assert pick_best(table).first()["alpha"] == chosen["alpha"]
    done = evaluate(df, "y", "a", "b", chosen["alpha"], chosen["t"]).first()
    assert np.isclose(done["auroc"], best[4]) and np.isclose(done["auprc"], best[5]) and np.isclose(done["min_ps"], best[6])


@pytest.mark.parametrize("shape", ["even", "one score", "crowded"])
def test_grid_in_chunks(spark, monkeypatch, shape):
    """Many blocks and chunks give what one gives; no more than a quarter of pairs times weights is handed on."""
    monkeypatch.setattr(ensemble, "BLOCK_PAIRS", 128)
    monkeypatch.setattr(ensemble, "CHUNK_SCORES", 100)
    rng = random.Random(5)
    second = {"even": rng.random, "one score": lambda: 0.25, "crowded": lambda: 0.5 + rng.choice([0, 1e-12, 1e-9])}[shape]
    rows = [(int(rng.random() < 0.4), round(rng.random(), 3), second()) for _ in range(900)]
    extra = [(1, None, 0.5), (0, 0.5, None), (1, float("nan"), 0.1), (None, 0.4, 0.25)]
    df = spark.createDataFrame(rows + extra, "y long, a double, b double")
    got = sorted(tuple(r) for r in grid_table(df, "y", "a", "b", 5, (0.05, 0.95, 7)).select("a_no", "t_no", "auroc", "auprc", "min_ps").collect())
    want = []
    for i, w in enumerate(np.linspace(0, 1, 5)):
        mix = [(y, w * a + (1 - w) * b) for y, a, b in rows]
        n, roc, ap = sum(y for y, _ in mix), fast_auroc(mix), direct_ap(mix)
        for j, t in enumerate(np.linspace(0.05, 0.95, 7)):
            tp, fp = (sum(1 for y, p in mix if p >= t and y == k) for k in (1, 0))
            want.append((i, j, roc, ap, min(tp / (tp + fp + 1e-12), tp / (n + 1e-12))))
    assert np.allclose(np.array(got), np.array(want))
    pairs = ensemble.score_pairs(df, "y", "a", "b")
    n, alphas = pairs.count(), np.linspace(0, 1, 5).tolist()
    handed = ensemble.packed_scores(pairs.repartition(8), alphas, ensemble._score_cuts(pairs, n, alphas), [0.5]).count()
    assert handed <= n * len(alphas) / 4


def test_grid_of_nothing(spark):
    assert grid_table(spark.createDataFrame([], "y long, a double, b double"), "y", "a", "b").isEmpty()
    one = grid_table(spark.createDataFrame([(1, 0.5, 0.5)], "y long, a double, b double"), "y", "a", "b", 3, (0.1, 0.9, 3))
    assert one.count() == 9 and one.where("auroc is null and auprc = 1").count() == 9


def test_other_measures(spark):
    df = spark.createDataFrame([(1.0, 1.2), (2.0, 1.0), (4.0, 4.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p", 0.25).first()
    assert np.isclose(r["mae"], 0.4) and np.isclose(r["rmse"], np.sqrt(1.04 / 3)) and np.isclose(r["within"], 2 / 3)
    w = M.pos_weight(frame(spark, [(1, 0.0), (0, 0.0), (0, 0.0), (0, 0.0)]), ["y"]).first()
    assert w["weight_y"] == 3.0
    ll = M.logloss(frame(spark, [(1, 0.5), (0, 0.5), (1, 1.0)]), "y", "p").first()["logloss"]
    assert np.isclose(ll, 2 * np.log(2) / 3, atol=1e-6)
