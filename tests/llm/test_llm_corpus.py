"""Near-dedup, surrogates, class language model, sharding and the pipeline."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitalgrid.llm import class_lm, near_dedup, sharding, surrogates
from vitalgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def documents(spark, folder=SF):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_by_hand(texts, k=4, percent=80):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in texts}, sets


@pytest.mark.parametrize("folder", [SF, SF2])
def test_near_dedup_query(spark, folder):
    texts = documents(spark, folder)
    want, sets = components_by_hand(texts)
    for r in QUERIES["op10_minhash_near_dedup"](spark, folder).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_dedup_groups(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    base = rng.choice(words, 120).tolist()
    texts = {}
    for i in range(1, 90):  # copies with one to seven changed words
        t = list(base)
        for at in rng.choice(len(t), i % 8, replace=False):
            t[at] = f"x{rng.integers(10**6)}"
        texts[i] = " ".join(t)
    line = " ".join(rng.choice(words, 30))
    for i in range(100, 130):  # different texts with a passage in common
        texts[i] = line + " " + " ".join(f"y{rng.integers(10**6)}" for _ in range(60))
    texts |= {200: "", 201: None, 202: "one", 203: "ONE ", 204: "a b c", 205: "a b", 206: "\n"}
    want, _ = components_by_hand(texts)
    rows = [(i, t, 0, "n", 1) for i, t in texts.items()] + [(None, texts[1], 0, "n", 1), (1, texts[1], 0, "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, node string, root int")
    got = near_dedup.near_groups(df).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == (None if r.doc_id is None else want[r.doc_id]) for r in got)
    assert near_dedup.near_groups(df.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    """One doc_id has two texts: near copies of either follow that text's own class; of equal rows one stays."""
    rng = np.random.default_rng(8)
    w, v = (" ".join(f"{c}{i}" for i in rng.integers(0, 10**6, 60)) for c in "wv")
    rows = [(1, w), (1, v), (2, w + " x"), (3, v + " x"), (5, w + " y"), (6, v + " y"), (7, "alone here"), (1, w), (2, None), (2, None), (1, w.upper())]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int")
    got = near_dedup.near_groups(df).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (7, 7), (2, 2)}
    kept = near_dedup.drop_near_copies(df, 5).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept if r.doc_id != 1) == [(2, ""), (2, ""), (7, "alone here")]
    ones = [r.text.lower() for r in kept if r.doc_id == 1]
    assert sorted(ones) == sorted([w, v])
    again = df.unionByName(df.withColumn("n", F.col("n") + 100)).withColumn("_content", F.map_from_arrays(F.array("n"), F.array("n")))
    kept = near_dedup.drop_near_copies(again, 5)
    assert kept.columns == again.columns
    assert sorted((r.doc_id, r.text.lower()) for r in kept.collect() if r.text) == sorted([(1, w), (1, v), (7, "alone here")])


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, x) for x in range(2001, 2100)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        return i if root[i] == i else find(root[i])

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root if find(i) != i}
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


KINDS = re.compile(
    r"[\w.+-]+@[\w.-]+\.[a-z]+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]\d)|AKIA[0-9A-Z]{16}|[0-9a-f]{40}|(?<=password=)\w+"
)


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_surrogates_query(spark):
    texts = documents(spark, SF2)
    there, made = collections.defaultdict(set), collections.defaultdict(set)
    real = {e.lower() for t in texts.values() for e in KINDS.findall(t)}
    df = QUERIES["op6_pii_surrogates"](spark, SF2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    changed = 0
    for r in df.collect():
        old, new = KINDS.findall(texts[r.doc_id]), KINDS.findall(r.text)
        assert len(old) == len(new) and (r.text == texts[r.doc_id]) == (r.n_entities == 0)
        if not old:
            assert r.text == texts[r.doc_id]
        changed += bool(old)
        # What stands around the entities stays.
        assert KINDS.sub("#", r.text) == KINDS.sub("#", texts[r.doc_id])
        for a, b in zip(old, new):
            there[a].add(b)
            made[b].add(a)
            assert b.lower() not in real
            if re.fullmatch(r"\d{16}", a):
                assert luhn(a) <= luhn(b)
            if "." not in a or "@" in a:
                assert re.sub(r"[A-Za-z\d]", "a", a.split("@")[0]) == re.sub(r"[A-Za-z\d]", "a", b.split("@")[0])
    assert changed and all(len(x) == 1 for x in [*there.values(), *made.values()])


def test_surrogates_edges(spark):
    rows = [
        (1, "Mail Anna.B@Mail.example.com or anna.b@mail.example.com: +1 (499) 555-6503. Card 4111 1111 1111 1111 / 4111111111111111."),
        (2, "Mr. Smith met Frau Müller and Mr Smith; MR SMITH. Госпожа Иванова. key DE44500105175407324931, 123-45-6789."),
        (3, None), (4, ""), (None, "x@y.zz 1.2.3.4"), (5, "clean: Version 2.0. = no, 10:30, 1999-12-31"), (5, "again anna.b@mail.example.com"),
        (6, "-----BEGIN RSA PRIVATE KEY-----\nAbc12+/=\n-----END RSA PRIVATE KEY----- end"), (1, "Mail Anna.B@Mail.example.com"),
        (7, "y" * 5000 + " a@b.cc " + "z" * 5000),
    ]
    rows += rows[:1]
    df = spark.createDataFrame([(*r, "n", "w") for r in rows], "doc_id long, text string, n string, _new string")
    out = surrogates.replace_entities(df, "k", n_entities="n")
    assert out.columns == ["doc_id", "text", "_new", "n"] and out.count() == len(rows)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    one = next(t for t in got[1] if "Card" in t)
    mails = re.findall(r"\S+@\S+\.com", one)
    assert mails[0].lower() == mails[1] and mails[0] != mails[1] and "anna" not in one.lower()
    cards = re.search(r"Card ([\d ]+) / (\d+)", one)
    assert cards[1].replace(" ", "") == cards[2] and cards[2] != "4111111111111111" and luhn(cards[2])
    assert any(mails[1] in t for t in got[5]) and rows[5][1] in got[5]
    assert got[3] == [None] and got[4] == [""] and "y.zz" not in got[None][0] and "Abc12" not in got[6][0]
    names = re.match(r"Mr\. (\w+) met Frau (\w+) and Mr (\w+);.*Госпожа (\w+)", got[2][0])
    assert names[1] == names[3] != "Smith" and names[2].endswith(("lina", "retta", "nia", "della")) and re.fullmatch("[А-я]+", names[4])
    other = surrogates.replace_entities(df, "other key").where("doc_id = 7").first().text
    assert other != got[7][0] and len(other) == 10008
    assert surrogates.replace_entities(df.limit(0), "k").count() == 0


def test_surrogate_collisions(spark):
    """All 900 numbers of a tiny format: every attempt that is taken moves on."""
    df = spark.createDataFrame([(i, f"123-45-{i:04d}") for i in range(1500)], "doc_id long, text string")
    out = [r.text for r in surrogates.replace_entities(df, "k").collect()]
    assert len(set(out)) == 1500 and not {f"123-45-{i:04d}" for i in range(1500)} & set(out)
    found = surrogates.find_entities(df).select("kind", "norm")
    twice = surrogates.assign(found.union(found), "k").collect()
    assert len(twice) == 1500


def test_surrogates_grow(spark):
    """More entities than the first length of a format has surrogates."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)] + list("àáâãäåæçèéêëìíîïñòóôõöøùúûü")
    mails = [(i, f"{c}@mail.example.com") for i, c in enumerate(letters)]
    phones = [(100 + i, f"+1 {i:02d} {j:02d}") for i in range(100) for j in range(100)]
    greek = "αβγδεζηθικλμνοπρστυφχψω"
    names = [(200, f"Mr {a.upper()}{b}{c}{d}") for a, b, c, d in itertools.product(greek[:20], greek[:20], greek[:20], greek[:2])]
    df = spark.createDataFrame(mails + phones + names, "doc_id long, text string")
    out = [r.text for r in surrogates.replace_entities(df, "k").collect()]
    old = {t for _, t in mails + phones + names}
    assert len(out) == len(old) == len(set(out)) and not old & set(out)


def test_lm_query(spark):
    texts = documents(spark)
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    gained = 0.0
    for r in QUERIES["op5_class_lm"](spark, SF).collect():
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        gained += (r.score - r.base_score) * r.held_out
    assert gained > 0


def test_lm_model_by_hand(spark):
    """Scores follow from the model's classes; probabilities sum to one."""
    rng = np.random.default_rng(2)
    groups = [["red", "blue", "green"], ["cat", "dog", "cow"], ["runs", "eats", "sleeps"]]
    texts = [" ".join(w for _ in range(6) for g in groups for w in [g[rng.integers(3)]]) for _ in range(60)] + [None, "", "new words here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("c", F.lit(1)).withColumn("word", F.lit("x"))
    held = F.col("doc_id") >= 60
    model, counts = class_lm.fit(df, ~held)
    assert np.allclose((10.0**model.moves).sum(1), 1)
    unit = {r.word: r.c for r in counts.collect()}
    assert len(unit) == 9 and sum(unit.values()) == 60 * 18 and model.n == 60 * 19 and model.v == 10
    rows = {r.doc_id: r for r in class_lm.scores(df, held).collect()}
    assert len(rows) == len(texts)
    assert rows[60].n_tokens == 1 and rows[60].score == rows[61].score and rows[62].n_known == 1
    end = len(model.moves) - 1
    assert math.isclose(rows[60].score, model.moves[end, end])
    base = sum(r.base_score for r in rows.values() if not r.held_out)
    score = sum(r.score for r in rows.values() if not r.held_out)
    assert score > base + 60 * 18 * math.log10(2)  # the three groups follow each other


def test_exchange_gain_is_the_objective():
    rng = np.random.default_rng(7)
    n, k = 12, 4
    pairs = rng.integers(0, 9, (n, n)).astype(float)
    cls = np.append(rng.integers(0, k - 1, n - 1), k - 1)

    def matrix(c):
        out = np.zeros((k, k))
        np.add.at(out, (c[:, None].repeat(n, 1), c[None, :].repeat(n, 0)), pairs)
        return out

    def value(c):
        m = matrix(c)
        return sum(x * math.log(x) for x in m.ravel() if x > 1) - sum(x * math.log(x) for s in (m.sum(0), m.sum(1)) for x in s if x > 1)

    for u in range(n - 1):
        right, left = np.bincount(cls, pairs[u], k), np.bincount(cls, pairs[:, u], k)
        best, gain = class_lm.best_class(matrix(cls), right, left, pairs[u, u], int(cls[u]))
        found = []
        for c in range(k - 1):
            moved = cls.copy()
            moved[u] = c
            found.append(value(moved) - value(cls))
        assert math.isclose(max(found), gain, abs_tol=1e-6) and math.isclose(found[best], max(found), abs_tol=1e-6)


def test_lm_edges(spark):
    df = spark.createDataFrame([(1, "a b a"), (1, "a b a"), (None, "A\x0bb"), (2, "x" * 100_000)], "doc_id long, text string")
    rows = class_lm.scores(df, F.lit(False)).collect()
    assert len(rows) == 4 and len({(r.score, r.base_score) for r in rows if r.doc_id == 1}) == 1
    assert {r.train_tokens for r in rows} == {4 + 4 + 3 + 2}
    none = class_lm.scores(df, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)} and all(math.isfinite(r.score) for r in none)
    assert class_lm.scores(df.limit(0), F.lit(True)).count() == 0


def test_lm_rare_words_by_their_context(spark):
    """Rare words of one ending and one count have the class of their own neighbours."""
    rng = np.random.default_rng(5)
    groups = [["red", "blue", "green"], ["cat", "dog", "cow"], ["runs", "eats", "sleeps"]]
    rows = []
    for i in range(3600):
        words = [w for _ in range(6) for g in groups for w in [g[rng.integers(3)]]]
        if i < 1200:  # 200 rare words, six times each, below a share of 1e-4
            words[3 + 1 + i % 2] = f"rare{i % 200:03d}xyz"
        rows.append((i, " ".join(words)))
    asked = [(10_000 + i, f"red rare{i:03d}xyz runs") for i in range(200)]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string")
    got = {r.doc_id: r for r in class_lm.scores(df, F.col("doc_id") >= 10_000).collect()}
    assert all(got[10_000 + i].n_known == 4 for i in range(200)) and 6 < got[0].train_tokens * 1e-4
    right = min(got[10_000 + i].score for i in range(0, 200, 2))
    assert right > max(got[10_000 + i].score for i in range(1, 200, 2))
    assert class_lm.classes_for(10**6 + 10**9) >= 500 and class_lm.classes_for(0) == class_lm.CLASSES


def check_shards(rows, texts, shards, slack):
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) <= set(range(shards)) and len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / shards
    assert max(sizes.values()) <= mean * (1 + slack) and min(sizes.values()) >= mean * (1 - slack)


def test_sharding_query(spark):
    rows = QUERIES["op8_kd_sharding"](spark, SF2).collect()
    check_shards(rows, documents(spark, SF2), 8, 0.06)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("dims", [["lang", "n"], ["n"], []])
def test_sharding_edges(spark, dims):
    texts = {i: f"text {i} " * (i % 13) for i in range(400)} | {500 + i: "the same hot text " * 5 for i in range(300)} | {900: None, 901: ""}
    rows = [(i, t, None if i % 7 == 0 else "ab"[i % 2] * 3, float("nan") if i % 5 == 0 else float(i % 17), "clash") for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n double, shard string")
    got = sharding.kd_shards(df, dims, shards=5).withColumnsRenamed({"_size": "size", "_crc": "text_crc32"}).collect()
    check_shards(got, texts, 5, 0.12)
    same = collections.defaultdict(set)
    for r in got:
        if r.doc_id < 400:
            same[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for t, s in same.items() if t)  # groups that aren't heavy stay together
    assert sharding.kd_shards(df.limit(0), dims).count() == 0
    twice = sharding.kd_shards(df.union(df), dims, shards=3)
    assert twice.select("shard", "slot").distinct().count() == 2 * len(rows)


def test_sharding_is_a_tree(spark):
    """With one dimension and distinct texts the shards are the weighted quantile ranges."""
    texts = {i: "x" * (1 + (i * 37) % 90) + str(i) for i in range(600)}
    df = spark.createDataFrame([(i, t, float(i)) for i, t in texts.items()], "doc_id long, text string, n double")
    shard = {r.doc_id: r.shard for r in sharding.kd_shards(df, ["n"], shards=4).collect()}
    assert [shard[i] for i in range(600)] == sorted(shard[i] for i in range(600))


def tree_by_hand(points, sizes, shards):
    """Shard of each point: the widest dimension, as a share of the whole range, is cut at the weighted median."""
    dims = len(points[0])
    span = [max(p[d] for p in points) - min(p[d] for p in points) for d in range(dims)]
    shard = [0] * len(points)

    def split(rows, first, k):
        for i in rows:
            shard[i] = first
        if k == 1:
            return
        width = [(max(points[i][d] for i in rows) - min(points[i][d] for i in rows)) / span[d] for d in range(dims)]
        d = max(range(dims), key=lambda d: (width[d], -d))
        rows = sorted(rows, key=lambda i: points[i][d])
        want, left = sum(sizes[i] for i in rows) * (k // 2) // k, []
        for i in rows:
            if want < sizes[i]:
                left += [i] if 2 * want >= sizes[i] and want > 0 else []
                break
            left.append(i)
            want -= sizes[i]
            if want == 0:
                break
        split(left, first, k // 2)
        split([i for i in rows if i not in set(left)], first + k // 2, k - k // 2)

    split(list(range(len(points))), 0, shards)
    return shard


def test_sharding_is_a_tree_in_two_dimensions(spark):
    rng = np.random.default_rng(6)
    n = 500
    points = list(zip(rng.permutation(n).tolist(), (rng.permutation(n) ** 2).tolist()))
    texts = ["y" * int(rng.integers(1, 60)) + str(i) for i in range(n)]
    df = spark.createDataFrame([(i, t, *p) for i, (t, p) in enumerate(zip(texts, points))], "doc_id long, text string, a long, b long")
    got = {r.doc_id: r.shard for r in sharding.kd_shards(df.repartition(5), ["a", "b"], shards=6).collect()}
    assert [got[i] for i in range(n)] == tree_by_hand(points, [len(t) + 1 for t in texts], 6)


def test_sharding_tells_texts_with_a_common_start_apart(spark):
    rows = [(i, f"{i:04d}", "common_crawl_" + "ab"[i % 2], {"k": i}, i, "s") for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, _meta int, `c0.x` string")
    out = sharding.kd_shards(df, ["source"], shards=2)
    assert out.columns == ["doc_id", "source", "m", "_meta", "c0.x", "_size", "_crc", "shard", "slot"]
    seen = collections.Counter((r.source[-1], r.shard) for r in out.collect())
    assert seen == {("a", 0): 32, ("b", 1): 32}
    assert all(r.m == {"k": r.doc_id} and r["_meta"] == r.doc_id for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_pipeline(spark):
    folder = SF2
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = documents(spark, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_near_dedup", "pii_surrogates", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            docs = out.cache()
            kept[name] = {r.doc_id: r for r in docs.collect()}
            assert all(r.n_chars == len(r.text) for r in kept[name].values())
    assert set(kept["line_dedup"]) == set(kept["quality_rules"]) < set(texts)
    near, lines = kept["minhash_near_dedup"], kept["line_dedup"]
    want, _ = components_by_hand({i: r.text for i, r in lines.items()}, k=5)
    assert set(near) == {i for i in lines if want[i] == i}
    assert all(near[i].text == lines[i].text for i in near)
    last = kept["pii_surrogates"]
    assert set(last) == set(near) and any(last[i].text != near[i].text for i in near)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(last)
