"""Block scores and pooling against a direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators.scoring import multi_scale_scores, pooled_scores


def series_of(records, scales):
    """Records are (gcs, f1, f2) in order; None is missing."""
    out = []
    for s in scales:
        n = len(records) if s == "full" else s
        for at in range(len(records) - n + 1):
            block = records[at : at + n]
            mean = lambda xs: sum(xs) / len(xs) if xs else None
            cols = [mean([r[i] for r in block if r[i] is not None]) for i in range(3)]
            feats = [c for c in cols[1:] if c is not None]
            out.append(((cols[0] or 0) * 4 / 15 + (mean(feats) or 0)) / 8)
    return out


@pytest.fixture(scope="module")
def visits():
    rng = random.Random(5)
    maybe = lambda v: None if rng.random() < 0.3 else v
    lengths = [1, 2, 3, 4, 5, 6, 30, 200]
    return {k: [(maybe(float(rng.randrange(3, 16))), maybe(float(rng.randrange(4))), maybe(float(rng.randrange(4)))) for _ in range(n)] for k, n in enumerate(lengths)}


def frame(spark, visits):
    data = [(k, i + 1, len(v), *r) for k, v in visits.items() for i, r in enumerate(v)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "k long, at long, n long, gcs double, f1 double, f2 double")


@pytest.mark.parametrize("scales", [(3, 5, "full"), (5, 10, "full"), ("full",), (2,)])
@pytest.mark.parametrize("stride", [16, 4096])
def test_series(spark, visits, scales, stride):
    out = multi_scale_scores(frame(spark, visits), ["k"], "at", "n", ["f1", "f2"], "gcs", scales, stride)
    got = {}
    for r in out.orderBy("k", "pos").collect():
        got.setdefault(r["k"], []).append((r["pos"], r["n_scores"], r["score"]))
    for k, records in visits.items():
        want = series_of(records, scales)
        mine = got.get(k, [])
        assert [p for p, _, _ in mine] == list(range(len(want)))
        assert all(n == len(want) for _, n, _ in mine)
        assert np.allclose([s for _, _, s in mine], want)


@pytest.mark.parametrize("n", [1, 12, 24])
@pytest.mark.parametrize("scales", [(3, 5, "full"), (5,)])
def test_pooling(spark, visits, scales, n):
    out = pooled_scores(frame(spark, visits), ["k"], "at", "n", ["f1", "f2"], "gcs", scales, n)
    got = {r["k"]: [r[f"D{i}"] for i in range(n)] for r in out.collect()}
    assert set(got) == set(visits)
    for k, records in visits.items():
        series = series_of(records, scales)
        want = np.interp(np.linspace(0, 1, n), np.linspace(0, 1, len(series)), series) if series else np.zeros(n)
        assert np.allclose(got[k], want, atol=1e-9)


def test_no_python_and_no_gathering(spark, visits):
    out = pooled_scores(frame(spark, visits), ["k"], "at", "n", ["f1", "f2"], "gcs", (3, 5, "full"), 12)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan
    assert out.where(F.col("D0").isNull()).count() == 0
