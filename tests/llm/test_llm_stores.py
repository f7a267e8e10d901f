"""WARC archives and nearest neighbours."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import ann, warc
from vitalgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def pages(n):
    return [(i, f"http://x/{i}", (f"<p>page {i}</p>" * (i + 1)).encode(), None) for i in range(n)]


def record(page):
    import hashlib

    i, url, html, first = page
    return warc.record(i, url, html, hashlib.sha256(html).hexdigest(), first)


def salvage(data):
    return list(warc.Salvage(lambda o, n: data[o : o + n], len(data)).items())


def covered(items, size):
    at = 0
    for offset, length, *_ in items:
        assert offset == at
        at += length
    assert at == size


@pytest.mark.parametrize("pack", [lambda r: warc.member(r), lambda r: r])
def test_salvage(pack):
    parts = [pack(record(p)) for p in pages(12)]
    whole = b"".join(parts)
    items = salvage(whole)
    covered(items, len(whole))
    assert [x[2]["warc-record-id"] for x in items] == [f"<urn:page:{i}>" for i in range(12)]
    rng = random.Random(2)
    for _ in range(60):
        hit = sorted(rng.sample(range(12), 3))
        broken = list(parts)
        for k in hit:
            p = bytearray(broken[k])
            how = rng.randrange(3)
            if how == 0:
                p[rng.randrange(len(p))] ^= 1 << rng.randrange(8)
            elif how == 1:
                del p[rng.randrange(len(p)) :]
            else:
                p[:0] = rng.randbytes(rng.randrange(1, 40))
            broken[k] = bytes(p)
        data = b"".join(broken)
        items = salvage(data)
        covered(items, len(data))
        found = {x[2]["warc-record-id"] for x in items if x[2]}
        assert {f"<urn:page:{i}>" for i in range(12) if i not in hit} <= found
        assert all(x[2] is not None or x[3] for x in items)


def test_salvage_odd_archives():
    assert salvage(b"") == []
    assert [x[2] for x in salvage(b"\x00" * 3000)] == [None]
    one = warc.member(record(pages(1)[0]))
    assert salvage(one[:-1])[0][2] is None
    two = zlib.compressobj(6, zlib.DEFLATED, 31)
    two = two.compress(record(pages(1)[0]) * 2) + two.flush()
    assert [x[3] for x in salvage(two)] == ["more than a record in the member"]


def test_archives_on_disk(spark, tmp_path):
    big = "<b>" + "x" * 300
    rows = [(5, "u\r\nX: y", big, 1), (3, None, big, 1), (9, "u", big, 1), (3, None, big, 2), (1, "u", "short", 1), (2, "u", "short", 1), (4, "u", None, 1), (None, "u", big, 1),
            (7, "ü", "é" * 60, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file int")
    got = sorted(map(tuple, warc.round_trip(df).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=repr)
    want = [(5, 303, "revisit", 3), (3, 303, "response", None), (9, 303, "revisit", 3), (3, 303, "response", None), (1, 5, "response", None),
            (2, 5, "response", None), (4, 0, "response", None), (None, 303, "response", None), (7, 120, "response", None)]
    assert got == sorted(want, key=repr)
    assert warc.round_trip(df.limit(0)).count() == 0
    # A damaged file loses its record and reports the gap.
    manifest = warc.write_archives(warc.with_first(df), f"file://{tmp_path}/arc", rotate=1)
    assert manifest.count() == len(rows)
    name = manifest.orderBy(F.desc("n_bytes")).first()["file"].removeprefix("file://")
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 255
    open(name, "wb").write(bytes(data))
    kinds = [r.kind for r in warc.read_archives(manifest).collect()]
    assert kinds.count("gap") == 1 and kinds.count("record") == len(rows) - 1 and os.path.getsize(name) == len(data)
    payloads = {bytes(r.payload) for r in warc.read_archives(manifest).where("record_type = 'response'").collect()}
    assert payloads >= {b"short", "é".encode() * 60}


def exact(rows, queries, top):
    out = {}
    for qid, q in queries:
        scored = sorted((-sum(float(a) * float(b) for a, b in zip(q, v)), i) for i, v in rows if i != qid)
        out[qid] = [(i, -s) for s, i in scored[:top]]
    return out


def test_ann_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    x, ids = np.stack([v for _, v in rows]), np.array([i for i, _ in rows])
    found = {}
    for r in QUERIES["op2_pruned_graph"](spark, folder).collect():
        found.setdefault(r.query_id, []).append(r)
    queries = [k for k in range(len(ids)) if ids[k] % 20 == 0]
    assert set(found) == {int(ids[k]) for k in queries}
    hits = 0
    for k in queries:
        score = x @ x[k]
        score[k] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        got = sorted(found[int(ids[k])], key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        place = {int(i): n for n, i in enumerate(ids)}
        assert all(abs(r.score - score[place[r.vec_id]]) < 1e-12 for r in got)
        hits += len(best & {r.vec_id for r in got})
    assert hits >= 0.9 * 20 * len(queries)


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [0.5, 0.5]) for i in range(100, 140)]
    odd = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [])]
    rows = [(10, [1.0, 2.0]), (11, [3.0, -1.0]), (12, [1.0, 2.0]), (12, [1.0, 2.0]), (13, [9.0, 9.0]), (14, [1.0, 0.0, 0.0]), *same]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("shard", F.lit("clash"))
    asked = [(10, [1.0, 2.0]), (110, [0.5, 0.5]), (14, [1.0, 0.0, 0.0])]
    got = {}
    for r in ann.nearest(df, df.where("vec_id in (10, 110, 14, 1, 2, 3)"), top=5).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    pool = list({i: (i, v) for i, v in rows if len(v) == 2}.values())
    assert {k: sorted(v, key=lambda x: (-x[1], x[0])) for k, v in got.items()} == exact(pool, asked[:2], 5)
    assert ann.nearest(df.limit(0), df).count() == 0 and ann.nearest(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [1.0, 3e3, 1e20])
def test_ann_recall_with_long_vectors(spark, longest):
    """One long vector leaves the graphs of all others as they are."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= longest
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    hits = 0
    asked = range(20, 4000, 40)
    found = {}
    for r in ann.nearest(df, df.where("vec_id % 40 = 20")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for i in asked:
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(found[i] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.95 * 20 * len(asked)


def test_graph_prunes_and_connects():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    near, entry = ann.build_graph(x, degree=12, beam=24)
    assert near.shape == (600, 12) and all(len(set(r[r >= 0])) == (r >= 0).sum() for r in near) and not (near == np.arange(600)[:, None]).any()
    seen, todo = {entry}, [entry]
    while todo:
        for j in near[todo.pop()]:
            if j >= 0 and int(j) not in seen:
                seen.add(int(j))
                todo.append(int(j))
    assert len(seen) >= 595


def test_double_vectors_keep_their_precision(spark):
    """Scores are those of the original doubles; large finite components take part."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 8))
    x[7] *= 1e39
    x[8, 0] = 10.800000006900001
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, [float("inf")] * 8), (901, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in ann.nearest(df, df.where("vec_id % 50 = 0"), top=5).collect():
        assert np.isclose(r.score, float(x[r.query_id] @ x[r.vec_id]), rtol=1e-14) and r.vec_id not in (r.query_id, 900, 901)


def test_queries_in_slices_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 6)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = df.where("vec_id % 5 = 0")
    whole = sorted(map(tuple, ann.nearest(df, queries, top=7).collect()))
    monkeypatch.setattr(ann, "SLICE_QUERIES", 30)
    assert sorted(map(tuple, ann.nearest(df, queries, top=7).collect())) == whole and len(whole) == 700
