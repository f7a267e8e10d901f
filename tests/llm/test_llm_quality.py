"""The random field's fit and its sample."""

import numpy as np

from vitalgrid.llm import quality as Q
from vitalgrid.llm.textblock import TextBlock


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 2, 7, 3])
    at = np.concatenate(([0], np.cumsum(lengths)))
    x = np.concatenate((np.ones((at[-1], 1)), rng.normal(size=(at[-1], 3))), 1)
    task = Q.Fit(x, at, np.array([0, 1, 1, 0, 1]), np.array([0, 1, 1, 2, 3]), l2=0.01)
    theta = rng.normal(size=2 * 4 + 4)
    _, g = task.value_and_gradient(theta)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        up, down = (task.value_and_gradient(theta + s)[0] for s in (step, -step))
        assert np.isclose(g[i], (up - down) / 2e-5, atol=1e-7)


def test_a_document_counts_alike_in_one_chain_or_several():
    rng = np.random.default_rng(2)
    x = np.concatenate((np.ones((12, 1)), rng.normal(size=(12, 2))), 1)
    task = Q.Fit(x, np.array([0, 4, 8, 12]), np.array([0, 0, 1]), np.array([5, 5, 6]))
    assert np.isclose(task.per_line[:8].sum(), task.per_line[8:].sum())


def test_sample_keeps_neighbours():
    assert Q.sample_runs(3, 200, 256, 32) == [(3, 200)]
    runs = Q.sample_runs(10, 5000, 256, 32)
    assert len(runs) == 8 and runs[0] == (10, 42) and runs[-1][1] == 5000 and all(b - a == 32 for a, b in runs)
    assert all(b <= c for (_, b), (c, _) in zip(runs, runs[1:]))
    runs = Q.sample_runs(0, 257, 256, 32)
    assert sum(b - a for a, b in runs) == 256 and runs[-1][1] == 257


def test_share_of_repeated_words_does_not_depend_on_size():
    last = []
    for n in (1000, 100_000):
        data = b"a b c d e " * (n // 5)
        m = Q.measure(TextBlock(np.frombuffer(data, np.uint8), np.array([0, len(data)])))
        last.append(m.features[0, -1])
    assert np.allclose(last, np.log1p(1.0))
