"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from vitalgrid.llm import collocations as module
from vitalgrid.llm.collocations import TILE, collocations, count_tiles
from vitalgrid.llm.queries import QUERIES

FOLD = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, min_count, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    many = {p: c for p, c in f.items() if c >= min_count}
    inside = set()
    for (lang, words), c in many.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if many[lang, words[i : i + k]] == c:
                    inside.add((lang, words[i : i + k]))
    found = []
    for (lang, words), a in many.items():
        if len(words) < 2 or (lang, words) in inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, " ".join(words), a, left, right, n[lang], score))
    out = []
    for lang in {x[0] for x in found}:
        own = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(lang, i + 1, *x[1:]) for i, x in enumerate(own[:top])]
    return sorted(out)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["É", "éa", "A", "a", "𝔘x", "\x00", "B c"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [" ".join(rng.choices(words, k=7)) for _ in range(6)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " \t".join(rng.choices(words, weights, k=rng.randint(1, 12))))
            parts.append(rng.choice([" ", ".", ", ", "!\n", "\x0b", "  ", ";:", "\r\n"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "de", None, ""])))
    return rows + rows[:10] + [(None, "en"), ("", "de"), ("solo", "xx")]


def test_tiles_dense_and_sparse(monkeypatch):
    monkeypatch.setattr(module, "DENSE_PAIRS", 50)
    rng = np.random.default_rng(3)
    width = 3 * TILE + 5
    x, y = (np.minimum(rng.geometric(0.01, 4000) - 1 + rng.integers(0, 2, 4000) * 2 * TILE, width - 1) for _ in range(2))
    codes, counts = count_tiles(x, y, width)
    assert len(np.unique(codes)) == len(codes)
    assert dict(zip(codes.tolist(), counts.tolist())) == Counter((x * width + y).tolist())
    assert [len(c) for c in count_tiles(x[:0], y[:0], width)] == [0, 0]


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**62, 5, 2**63 - 1])
    assert module._unpacked(module._packed(values)).tolist() == values.tolist()
    assert module._packed(values[:0]) == b"" and not len(module._unpacked(b""))


@pytest.mark.parametrize("block_bytes,dense,known,merged", [(1 << 20, 1 << 16, 10**6, 10**6), (700, 20, 10**6, 50), (900, 20, 60, 200), (900, 20, 0, 200)])
def test_collocations_equal_plain_count(spark, monkeypatch, block_bytes, dense, known, merged):
    """Ids of frequent phrases broadcast, joined from some level on, and always joined."""
    monkeypatch.setattr(module, "KNOWN_SYMBOLS", known)
    monkeypatch.setattr(module, "MERGED_PAIRS", merged)
    monkeypatch.setattr(module, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(module, "DENSE_PAIRS", dense)
    rows = corpus(random.Random(11), 500)
    docs = spark.createDataFrame([(t, g, i, "x") for i, (t, g) in enumerate(rows)], "text string, lang string, id int, symbol string").repartition(5)
    got = collocations(docs, min_count=12)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = by_hand(rows, 12)
    assert len(expected) > 100 and sorted(map(tuple, got.collect())) == expected
    few = sorted(map(tuple, collocations(docs, min_count=12, top=7).collect()))
    assert few == by_hand(rows, 12, top=7)


def test_long_text_is_cut_where_pieces_end(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 64)
    text = "a b c. " * 300 + "a b " * 500 + "! c a b"
    rows = [(text, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, collocations(docs, min_count=100).collect())) == by_hand(rows, 100)


def test_products_beyond_64_bits(spark):
    """Scores come from decimals: 1000 * a * n and l * r pass 2^63 here."""
    from vitalgrid.llm.collocations import scored

    a, n, left, right = 3_000_000_000, 40_000_000_000_000, 5_000_000_000, 4_100_000_000
    rows = [("en", ["x", "y"], a, [left], [right], n)]
    got = scored(spark.createDataFrame(rows, "lang string, words array<string>, f long, heads array<long>, tails array<long>, n long")).first()
    assert got["score"] == 1000 * a * n // (left * right)


def test_empty_and_without_frequent_words(spark):
    docs = spark.createDataFrame([("a b", "en"), (None, None)], "text string, lang string")
    assert collocations(docs).count() == 0
    assert collocations(docs.limit(0)).count() == 0
    assert [tuple(r) for r in collocations(docs, min_count=1).collect()] == [("en", 1, "a b", 1, 1, 1, 2, 2000)]


def test_query(spark, tmp_path):
    rows = corpus(random.Random(5), 900)
    spark.createDataFrame(rows, "text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_tiled_collocations"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 100)


@pytest.mark.parametrize("numbers", [False, True])
def test_ids_are_asked_by_block_and_part(spark, numbers):
    """Blocks get the ids of their symbols by a packed row for each block and part, not by a row for each symbol."""
    named = (lambda i: i * i * 977 + 2**40) if numbers else (lambda i: f"é{i}")
    kind = "long" if numbers else "string"
    sets = {1: range(500), 2: range(250, 900), 3: [], 1 << 40: [0, 1000]}
    langs = {1: "en", 2: "de", 3: "en", 1 << 40: "en"}
    blocks = spark.createDataFrame(
        [(b, langs[b], [named(i) for i in s]) for b, s in sets.items()], f"block long, lang string, symbols array<{kind}>"
    )
    known = {("en", i): 3 * i for i in range(0, 500, 2)} | {("de", i): 7 * i for i in range(300, 1200)}
    if numbers:
        known = {("", i): 3 * i for i in range(0, 900, 2)}
    ranked = spark.createDataFrame([(g, named(i), n) for (g, i), n in known.items()], f"lang string, symbol {kind}, id long")
    rows = module.answers(blocks, ranked, ["symbol"] if numbers else ["lang", "symbol"], 5).collect()
    assert len(rows) <= 5 * len(sets)
    got = {}
    for r in rows:
        at = np.cumsum(module._unpacked(r["at"])).tolist()
        got |= {(r["block"], k): n for k, n in zip(at, module._unpacked(r["ids"]).tolist(), strict=True)}
    expected = {(b, k): known[g, i] for b, s in sets.items() for k, i in enumerate(s) if (g := "" if numbers else langs[b], i) in known}
    assert got == expected and len(expected) > 500
