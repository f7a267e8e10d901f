"""Line dedup, BPE, packing and quality rules against brute force."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import packing, quality
from vitalgrid.llm.bpe import PairIndex, digests, encoded
from vitalgrid.llm.line_dedup import dedup_lines, keep_bitmaps
from vitalgrid.llm.queries import ORACLES, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_lines string, _content string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary())


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def folded(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def by_hand(rows, min_chars, min_docs):
    holders = collections.defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(folded(line)) >= min_chars:
                holders[folded(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders[folded(x)]) < min_docs or doc == max(holders[folded(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_edges(spark):
    shared = "Shared line Éa of some length"
    rows = [(i, f"own {i}\n{shared}\n\n {shared.replace('S', 's')}\t", "x", "y") for i in range(4)]
    rows += [(4, shared.replace("É", "é"), "x", "y"), (5, None, "x", "y"), (6, "", None, None), (7, "\n\n", "", "")]
    rows += [(None, shared, "", ""), (3, rows[3][1], "x", "y"), (3, shared + "\nother", "", "")]
    rows += [(8, "k" * 70 + "\n" + "\n".join(f"{shared} {j % 3}" for j in range(200)), "", ""), (9, "\n".join(f"{shared} {j}" for j in range(3)), "", "")]
    rows += [(10, "Kelvin k", "", ""), (11, "kelvin K", "", ""), (12, "KELVIN K", "", "")]
    df = spark.createDataFrame(rows, DOCS)
    for chars, docs in ((5, 2), (5, 3), (1, 2)):
        got = dedup_lines(df, chars, docs, n_lines="n_lines", n_dropped="lost")
        assert got.columns == ["doc_id", "text", "_content", "n_lines", "lost"]
        got = [(r.doc_id, r.n_lines, r.lost, r.text or "") for r in got.collect()]
        assert sorted(got, key=repr) == by_hand(rows, chars, docs)
    bitmaps = {r.doc_id: r.words for r in keep_bitmaps(df, 5, 2).collect() if r.doc_id == 8}
    assert len(bitmaps[8]) == 4 and dedup_lines(df.limit(0)).count() == 0


def test_lines_plan_has_no_python(spark):
    plan = QUERIES["op1_line_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name, tables", [("op1_line_dedup", ["documents"]), ("op3_warc", ["pages"])])
def test_against_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    got = QUERIES[name](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(cur.fetchall(), key=repr)


def test_bpe_equals_library(library):
    codec = PairIndex(vocabulary())
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x1f", " ", " ", "1", "½", "é", "中", "'s", "'", "aaaa", "<|endoftext|>", "🎉",
             "", "\x85", ".", "Ⅷ", "́", "the ", "ing"]
    texts = ["", "aaaaaaaaa", " ", "x" * 3000] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)
    assert codec.decode([220, 150]) == library.decode([220, 150], skip_special_tokens=False)


def test_bpe_query(spark, library):
    texts = documents(spark)
    for r in QUERIES["op9_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edges(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (2, "a b"), (2, "a b")], "doc_id long, text string").withColumn("ids", F.lit("x"))
    got = {(r.doc_id, r.text): r.ids for r in encoded(df, vocabulary()).collect()}
    assert got[(1, None)] == [] and got[(None, "")] == [] and len(got[(2, "a b")]) == 2
    assert digests(df, vocabulary()).count() == 4 and digests(df.limit(0), vocabulary()).count() == 0


def check_packing(rows, texts, library, size):
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = library.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // size)
        assert all(r.length == size for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return len(by_sequence)


def test_packing_query(spark, library):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    used = check_packing(rows, documents(spark), library, 2048)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 2


def test_packing_edges(spark, library):
    texts = {1: None, 2: "", 3: "word " * 40, 4: "word " * 40, 5: "a " * 7, 6: "b"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit("clash"))
    rows = packing.pack_documents(df, vocabulary(), size=16).collect()
    check_packing(rows, texts, library, 16)
    assert packing.pack_documents(df.limit(0), vocabulary()).count() == 0
    twice = packing.pack_documents(df.union(df), vocabulary(), size=16)
    assert twice.count() == 2 * len(rows) and twice.select("sequence_id", "offset").distinct().count() == 2 * len(rows)


@pytest.mark.parametrize("seed, share", [(0, 1.0), (1, 0.05), (2, 0.0)])
def test_packing_plan(seed, share):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.clip((rng.lognormal(6, 1, 20000)).astype(int), 1, 2048), minlength=2049)
    counts = rng.binomial(counts, share) if share else np.bincount([2048, 2048, 1500, 1], minlength=2049)
    places = packing.plan(counts, 2048)
    filled = collections.Counter()
    for i, (length, first, sequence, _) in enumerate(places.tolist()):
        follows = i + 1 < len(places) and places[i + 1][0] == length
        upto = int(places[i + 1][1]) if follows else int(counts[length])
        assert first < upto
        for k in range(upto - first):
            filled[sequence + k] += length
    assert max(filled.values()) <= 2048 and sum(filled.values()) == int((counts * np.arange(2049)).sum())
    assert len(filled) <= 1.01 * sum(filled.values()) / 2048 + 8


def test_nnls():
    rng = np.random.default_rng(3)
    cols = packing.patterns(24)
    want = np.concatenate(([0], rng.integers(0, 50, 24))).astype(float)
    x = packing.nnls(cols, want)
    a = np.zeros((25, len(cols)))
    for k in range(3):
        np.add.at(a, (cols[:, k], np.arange(len(cols))), 1)
    a[0] = 0
    grad = a.T @ (a @ x - want)
    assert (x >= 0).all() and abs(grad[x > 0]).max() < 1e-2 * want.max() and grad.min() > -1e-2 * want.max()


def base_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered, seen, dup = set(), set(), 0
    for k in range(len(words) - 4):
        if grams[tuple(words[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_counts(spark):
    texts = [None, "", "\n", " ", "a", "a b c d e a b c d e", "é x <b> & |\n\n a\na\r\n a", "x " * 5000, "w\x1cx y\x0bz\x0c", "l1\nl1\nl1 \nl2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", F.lit(7)).withColumn("extra", F.lit(1))
    for r in quality.judge(df, None).collect():
        got = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        assert got == base_by_hand(texts[r.doc_id]) and r.kept == (not r.base_failed) and r.extra == 1
    assert quality.judge(df.limit(0), None).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(df, empty) is None


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(0)
    field = quality.Field(np.zeros(3), np.ones(3), rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    lengths = [1, 5, 0, 7, 3]
    x = rng.normal(size=(sum(lengths), 3))
    at = np.concatenate(([0], np.cumsum(lengths)))
    found = field.viterbi(x, at)
    score = field.scores(x)
    for a, b in zip(at, at[1:]):
        def total(labels):
            return sum(score[a + i, c] for i, c in enumerate(labels)) + sum(field.moves[p, q] for p, q in zip(labels, labels[1:]))

        best = max((tuple(int(c) for c in np.binary_repr(k, b - a)) for k in range(2 ** (b - a))), key=total) if b > a else ()
        assert tuple(found[a:b]) == best


def test_quality_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_crf_quality"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_by_hand(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_held_out_accuracy(spark):
    """Fitted on two thirds of the labels, judged on the others."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    field = quality.train(docs, labels.where(~held))
    rows = quality.judge(docs.select("doc_id", "text"), field).join(labels.where(held), "doc_id").where("not base_failed").collect()
    right = [(r.kept, r.quality) for r in rows]
    good = [k for k, q in right if q == 1]
    bad = [k for k, q in right if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_chunks_looked_up_once_a_block(library):
    """A block's distinct chunks are looked up once each, whatever their number of occurrences; the ids are the library's."""
    cache = packing.library_cache(vocabulary())

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    cache.ids = Counted(cache.ids)
    pieces = ["a", "é", " ", "  ", "\n", ".", "\t ", "7", "'s", "\x1c", "　", "<|endoftext|>", "B,", "\n ", " \n", "x.\ny", "x.\ny,", "\x00"]
    rng = random.Random(4)
    texts = ["", " ", "one two. two\nthree " * 2000] + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(400)]
    for part in (texts[:3], texts):  # unknown and known
        assert [np.frombuffer(x, "<u4").tolist() for x in cache.ids_of(part)] == [
            x.ids for x in library.encode_batch(part, add_special_tokens=False)
        ]
    assert Counted.asked < 6000


def test_words_encoded_once_whatever_stands_beside_them(library):
    """Words met in ever other company (marks, line breaks, quotes) are neither looked up nor encoded apart; the ids are the library's."""
    cache = packing.library_cache(vocabulary())
    encode, asked = cache.encode, []
    cache.encode = lambda words: asked.extend(words) or encode(words)
    words = [a + b for a in "bdfgklmnprst" for b in ("a", "é", "oon", "中", "՘", "½")]
    rng = random.Random(6)
    breaks = [" ", ".\n", ", ", "\n\n", "'s ", "   ", "\t", "!", "'re\r\n", "<|endoftext|>", " '", "\x1c"]
    texts = ["".join(rng.choice(words) + rng.choice(breaks) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for part in (texts[:1500], texts):
        assert [np.frombuffer(x, "<u4").tolist() for x in cache.ids_of(part)] == [
            x.ids for x in library.encode_batch(part, add_special_tokens=False)
        ]
    assert len(asked) == len(set(asked)) < 600 and len(cache.ids) < 600
