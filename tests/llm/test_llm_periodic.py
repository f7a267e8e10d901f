"""Periodic runs against a search over all lags, and the registered query against a plain recomputation."""

import hashlib
import random
import re
import zlib

import numpy as np

from vitalgrid.llm.periodic import collapse_runs, find_runs

from vitalgrid.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def all_runs(words):
    """(start, period, length) of every run, lag by lag."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(12, 2 * q):
                out.setdefault((i, length), q)
            i = max(i + 1, j)
    return sorted((s, q, length) for (s, length), q in out.items())


def collapsed(words, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_find_runs_equals_search_over_all_lags():
    rng = random.Random(7)
    for _ in range(400):
        flat, expected, base = [], [], 0
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.randint(0, 160), rng.choice([1, 2, 3, 6])
            w = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                p = rng.randint(1, n)
                w = [w[i % p] for i in range(n)]
                for _ in range(rng.randint(0, 3)):
                    w[rng.randrange(n)] = rng.randrange(letters)
            expected += [(s + len(flat), q, length) for s, q, length in all_runs(w)]
            flat, base = flat + [x + base for x in w], base + letters
        start, length, period = find_runs(np.array(flat, np.int64))
        assert list(zip(start.tolist(), period.tolist(), length.tolist())) == expected


def test_periods_whose_grams_repeat_inside_one_period():
    """Each short gram occurs several times a period: neighbouring occurrences alone would miss the period."""
    rng = random.Random(3)
    blocks = [[rng.randrange(2) for _ in range(9)] for _ in range(3)]
    order = [0, 1, 0, 2, 0, 1, 1, 2, 0, 0, 2, 1]
    period = [x for b in order for x in blocks[b]]
    words = period * 3 + [5, 6]
    start, length, lag = find_runs(np.array(words))
    assert list(zip(start.tolist(), lag.tolist(), length.tolist())) == all_runs(words)


def test_work_grows_with_the_text_not_its_square():
    import time

    begin = time.perf_counter()
    start, length, period = find_runs(np.zeros(400_000, np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [400_000], [1])
    assert time.perf_counter() - begin < 30


def test_collapse_runs_edges(spark):
    beat = " ".join(["a b\t\x0bc"] * 5)
    long_text = " ".join(f"w{i}" for i in range(300_000))  # over a segment
    rows = [
        (1, None, 1), (2, "", 2), (3, " \n ", 3), (4, beat, 4), (4, beat, 5), (5, "x " * 11, 6), (6, "x " * 12, 7), (7, "é f g " * 6, 8),
        (8, long_text, 9), (9, long_text + " y z" * 400_000, 10), (None, "q", 11),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumnRenamed("runs", "RUNS")
    found = {}
    for r in collapse_runs(docs.repartition(3)).collect():
        found.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    assert found[1] == found[2] == found[3] == [([], "")]
    assert found[4] == [([(0, 15, 3)], "a b c")] * 2
    assert found[5] == [([], " ".join("x" * 11))] and found[6] == [([(0, 12, 1)], "x")]
    assert found[7] == [([(0, 12, 2)], "é f g")]
    assert found[8] == [([], long_text)]
    assert found[9] == [([(300_000, 800_000, 2)], long_text + " y z")]
    assert found[None] == [([], "q")]
    assert collapse_runs(docs.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = [rng.choice(["a", "b", "cé", "d,", " e"]) for _ in range(rng.choice([0, 1, 5, 12, 60, 300]))]
        rows.append((i * 7, rng.choice([" ", "\n", " \t"]).join(words) if i % 50 else None))
    rows += rows[:3]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        w = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = all_runs(w)
        top = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(w, runs))]
        stats = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
        expected.append((doc_id, len(runs), *stats, *digest))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
