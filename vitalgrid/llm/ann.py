"""Nearest neighbours by robust-pruned directed graphs, one per shard.

Distinct vectors are dealt to shards by hash. A shard's graph grows in batches: a
greedy beam search proposes neighbours for each new vector, relaxed distance
pruning keeps those that no kept neighbour is ``ALPHA`` times closer to, and reverse edges
are pruned the same way. A query runs a beam search in every shard and the best of all
shards are merged. Graphs are built on vectors with one more coordinate, which
makes the largest inner product the smallest distance; it is measured from the longest vector's
length, so that it is small for short vectors, and all distances are in double precision. A
search orders by the products alone; scores are exact.

A shard holds 65,536 distinct vectors at most on average; there are ``SHARDS`` at least. Of more than ``SLICE_QUERIES`` queries
each shard's are cut into slices by hash, which load its graph anew. Vectors are kept in double precision.

Defined cases: vectors that are null, zero or hold a null or non-finite component take
no part, nor do rows without a vec_id; vectors of different lengths never meet; equal
vectors are one point of the graph with their smallest ids, as many as a result can
hold; a row given twice counts once; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalgrid.llm.common import stored

TOP = 20
SHARDS = 8
SHARD_ROWS = 65_536
DEGREE = 32
BUILD_BEAM = 64
BEAM = 96
ALPHA = 1.2
BATCH = 1024
SLICE_QUERIES = 16_384

INDEX_SCHEMA = "dim int, shard int, slot int, vec binary, near binary, ids array<long>"


def valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def search_graph(x: np.ndarray, near: np.ndarray, entry: int, queries: np.ndarray, beam: int, trail: bool = False, products: bool = False):
    """Beam searches of all queries together; squared distances, or with ``products`` the negative products, doubled.

    Returns ids and distances of the final beams (-1 and inf where short), and with
    ``trail`` the nodes that were expanded.
    """
    n_q = len(queries)
    norms = np.zeros(len(x), x.dtype) if products else np.einsum("ij,ij->i", x, x)
    ids = np.full((n_q, beam), -1, np.int32)
    dist = np.full((n_q, beam), np.inf, x.dtype)
    open_ = np.zeros((n_q, beam), bool)
    seen = np.zeros((n_q, len(x)), bool)
    ids[:, 0], open_[:, 0], seen[:, entry] = entry, True, True
    dist[:, 0] = norms[entry] - 2 * (queries @ x[entry])
    walked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.arange(n_q)
    while len(live):
        best = np.where(open_[live], dist[live], np.inf).argmin(1)
        node = ids[live, best]
        open_[live, best] = False
        if trail:
            walked.append((live, node, dist[live, best]))
        around = near[node]
        good = around >= 0
        at = np.where(good, around, 0)
        good &= ~seen[live[:, None], at]
        seen[np.broadcast_to(live[:, None], at.shape)[good], at[good]] = True
        d = norms[at] - 2 * np.einsum("qrd,qd->qr", x[at], queries[live])
        d[~good] = np.inf
        all_d = np.concatenate((dist[live], d), 1)
        pick = np.argpartition(all_d, beam - 1, 1)[:, :beam]
        dist[live] = np.take_along_axis(all_d, pick, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], np.where(good, around, -1)), 1), pick, 1)
        open_[live] = np.take_along_axis(np.concatenate((open_[live], good), 1), pick, 1)
        live = live[open_[live].any(1)]
    if not trail:
        return ids, dist
    width = max(len(walked), 1)
    path = np.full((n_q, width), -1, np.int32)
    far = np.full((n_q, width), np.inf, x.dtype)
    for k, (who, node, d) in enumerate(walked):
        path[who, k], far[who, k] = node, d
    return np.concatenate((ids, path), 1), np.concatenate((dist, far), 1)


def robust_prune(x: np.ndarray, points: np.ndarray, cands: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of each point's candidates (-1: none) the diverse nearest ones, at most ``degree``."""
    at = np.maximum(cands, 0)
    vectors = x[at]
    gap = vectors - x[points][:, None, :]
    d = np.einsum("bcd,bcd->bc", gap, gap)
    d[(cands < 0) | (cands == points[:, None])] = np.inf
    order = np.argsort(d, 1, kind="stable")
    d, at = np.take_along_axis(d, order, 1), np.take_along_axis(at, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= at[:, 1:] != at[:, :-1]
    out = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    norms = np.einsum("bcd,bcd->bc", vectors, vectors)
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        first = alive.argmax(1)
        out[some, k] = at[rows[some], first[some]]
        chosen = vectors[rows, first]
        between = norms + norms[rows, first][:, None] - 2 * np.einsum("bcd,bd->bc", vectors, chosen)
        alive &= alpha * alpha * between > d
        alive[rows, first] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(neighbours, entry point); the vectors' order is random already."""
    n = len(x)
    near = np.full((n, degree), -1, np.int32)
    mid = x.mean(0)
    entry = int(((x - mid) ** 2).sum(1).argmin()) if n else 0
    order = np.concatenate(([entry], np.delete(np.arange(n), entry))) if n else np.arange(0)
    done = 1
    while done < n:
        new = order[done : done + min(done, BATCH)]
        cands, d = search_graph(x, near, entry, x[new], beam, trail=True)
        keep = np.argsort(d, 1, kind="stable")[:, : 2 * beam]
        # New vectors of one batch don't see each other in the graph; their nearest are proposed as well.
        mates = x[new] @ x[new].T
        norms = np.einsum("ij,ij->i", x[new], x[new])
        mates = norms[None, :] - 2 * mates
        np.fill_diagonal(mates, np.inf)
        k = min(8, len(new))
        close = new[np.argpartition(mates, k - 1, 1)[:, :k]]
        near[new] = robust_prune(x, new, np.concatenate((np.take_along_axis(cands, keep, 1), close), 1), degree, alpha)
        done += len(new)
        _add_reverse(x, near, new, degree, alpha)
    return near, entry


def _add_reverse(x: np.ndarray, near: np.ndarray, new: np.ndarray, degree: int, alpha: float) -> None:
    source = np.repeat(new, degree)
    target = near[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    have = (near[target] == source[:, None]).any(1)
    source, target = source[~have], target[~have]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    for a in range(0, len(nodes), BATCH):
        some, f, c = nodes[a : a + BATCH], first[a : a + BATCH], count[a : a + BATCH]
        extra = np.full((len(some), int(c.max())), -1, np.int32)
        row = np.repeat(np.arange(len(some)), c)
        extra[row, np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] = source[np.repeat(f, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)]
        free = (near[some] < 0).sum(1)
        fits = c <= free
        for i in np.flatnonzero(fits):
            line = near[some[i]]
            line[np.flatnonzero(line < 0)[: c[i]]] = extra[i, : c[i]]
        full = np.flatnonzero(~fits)
        if len(full):
            near[some[full]] = robust_prune(x, some[full], np.concatenate((near[some[full]], extra[full]), 1), degree, alpha)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """One more coordinate, which would make all vectors as long as the longest of the table, less that length.

    Distances don't change by the shift, and nothing large cancels in them.
    """
    x = x.astype(np.float64)
    own = np.einsum("ij,ij->i", x, x)
    lift = own / np.maximum(np.sqrt(top) + np.sqrt(np.maximum(0.0, top - own)), np.finfo(np.float64).tiny)
    return np.concatenate((x, lift[:, None]), 1)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Runs of rows of one (dim, shard), in order."""
    for batch in batches:
        dim, shard = (np.asarray(batch.column(c)) for c in ("dim", "shard"))
        cuts = np.flatnonzero((dim[1:] != dim[:-1]) | (shard[1:] != shard[:-1])) + 1
        edges = [0, *cuts.tolist(), len(dim)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield (int(dim[a]), int(shard[a])), batch.slice(a, b - a)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        vec = pa.array([np.asarray(v.values, np.float64).tobytes() for v in lists], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [vec if n == "v" else batch.column(n) for n in batch.schema.names], ["vec" if n == "v" else n for n in batch.schema.names]
        )


def vectors_of(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    return rows.where(valid(F.col(vector)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )


def build_index(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """A row per distinct vector: its shard, its neighbours' slots, and its smallest ids."""
    points = vectors_of(rows, id_col, vector).distinct()
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    points = points.withColumn("nth", nth).where(F.col("nth") <= top + 1)
    points = points.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = stored(points)
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("big")).first()
    # Graphs are built on multiples of the largest component, whose squares don't overflow.
    shards, scale = max(SHARDS, -(-facts["n"] // SHARD_ROWS)), facts["big"] or 1.0
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale))
    longest = points.agg(F.max(length)).first()[0] or 0.0
    dealt = points.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "v", "ids")
    dealt = stored(dealt.mapInArrow(_packed, "dim int, shard int, vec binary, ids array<long>"))

    def build(batches):
        held, now = [], None

        def finish():
            table = pa.Table.from_batches(held).combine_chunks()
            order = np.array(sorted(range(len(table)), key=lambda i: table["vec"][i].as_py()))
            table = table.take(pa.array(np.random.default_rng(7).permutation(order)))
            near, entry = build_graph(lifted(_matrix(table["vec"].combine_chunks()) / scale, longest))
            n = len(table)
            slot = np.arange(n, dtype=np.int32)
            # The entry point is the first slot.
            swap = slot.copy()
            swap[[0, entry]] = swap[[entry, 0]]
            near = np.where(near >= 0, swap[np.maximum(near, 0)], -1).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [table["dim"].combine_chunks(), table["shard"].combine_chunks(), pa.array(swap[slot]), table["vec"].combine_chunks(),
                 pa.array([r.tobytes() for r in near], pa.binary()), table["ids"].combine_chunks()],
                ["dim", "shard", "slot", "vec", "near", "ids"],
            )

        for key, part in _groups(batches):
            if held and key != now:
                yield finish()
                held = []
            now = key
            held.append(part)
        if held:
            yield finish()

    spread = dealt.repartitionByRange(shards, "shard", "dim").sortWithinPartitions("shard", "dim")
    return stored(spread.mapInArrow(build, INDEX_SCHEMA))


def search_index(index: DataFrame, queries: DataFrame, top: int = TOP, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (id, v)."""
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    slices = max(1, -(-queries.count() // SLICE_QUERIES))
    parts = shards * slices
    # A shard's rows come before the queries, which stream past its graph; a slice has its own copy of them.
    asked = queries.mapInArrow(_packed, "id long, vec binary")
    own = F.pmod(F.xxhash64("id"), F.lit(slices))
    asked = asked.select(
        (F.octet_length("vec") / 8).cast("int").alias("dim"),
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: (s * slices + own).cast("int"))).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("slot"), "vec",
        F.lit(None).cast("binary").alias("near"), F.array("id").alias("ids"),
    )
    copies = F.explode(F.sequence(F.col("shard") * slices, F.col("shard") * slices + slices - 1)).alias("shard")
    rows = index.select("dim", copies, F.lit(0).alias("kind"), "slot", "vec", "near", "ids").union(asked)
    stream = rows.repartitionByRange(parts, "shard", "dim").sortWithinPartitions("shard", "dim", "kind", "slot")

    def run(batches):
        now, held, graph = None, [], None
        for key, part in _groups(batches):
            if key != now:
                now, held, graph = key, [], None
            kind = np.asarray(part.column("kind"))
            cut = int(np.searchsorted(kind, 1))
            if cut:
                held.append(part.slice(0, cut))
            if cut == len(kind) or not held:
                continue
            if graph is None:
                table = pa.Table.from_batches(held)
                x = _matrix(table["vec"].combine_chunks())
                near = np.frombuffer(b"".join(table["near"].to_pylist()), np.int32).reshape(len(x), -1)
                graph = x, near, table["ids"].to_pylist()
                step = max(1, min(BATCH, (64 << 20) // len(x)))
            x, near, ids = graph
            asked = part.slice(cut)
            for a in range(0, asked.num_rows, step):
                some = asked.slice(a, step)
                q = _matrix(some.column("vec"))
                found, _ = search_graph(x, near, 0, q, min(beam, len(x)), products=True)
                score = np.einsum("qrd,qd->qr", x[np.maximum(found, 0)], q)
                score[found < 0] = -np.inf
                out = []
                for (own,), line, values in zip(some.column("ids").to_pylist(), found, score):
                    best = [(-float(values[i]), v) for i in np.argsort(-values)[: top + 1] if line[i] >= 0 for v in ids[line[i]] if v != own]
                    # Ties at the end of the list are all inside top + 1 points or equal in score to its last one.
                    out += [(own, v, -s) for s, v in sorted(best)[:top]]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"]
                    )

    found = stream.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    return search_index(build_index(rows, id_col, vector, top), vectors_of(queries, id_col, vector).dropDuplicates(["id"]), top)
