"""MinHash near-dedup by an inverted join over signature coordinates.

Texts with the same shingle set form one class. Classes are the nodes and have numbers of their own; only
at the end do they get document ids, so that ids which several texts share confuse nothing. A node
is posted under each (coordinate, value) of its signature. A pair is a candidate if at
least ``MATCHES`` of ``COORDS`` coordinates agree. Coordinates whose value no other
node has cannot agree; of the m others a node needs to be looked up only under
its m - MATCHES + 1 rarest (the prefix: two candidates share at least one of them in a
common order of rarity), and the rest is counted on the signatures themselves
(the skip). Candidates are confirmed on the full sets.

Not all pairs of a group are formed. Shingles that a node shares with no other listed
node bound its overlap with anything: a node with too many of them is out, and two nodes
meet only if sizes and shared parts allow the similarity. First every node meets one node of
each of its lists, the one whose coordinates are the most common. Confirmed links join
nodes to components; then only nodes of different components that share a list meet. So every
link between candidates is either inside a component or confirmed itself.

At a similarity of 0.8 a pair has fewer than 32 of 64 agreeing coordinates with a
probability of about 2e-8, and less above.

Defined cases: a text without words has an empty set and is linked with nothing; a
text with fewer words than a shingle is one shingle; a null doc_id is left
alone (component null, kept); equal rows fall together, and the smallest doc_id is kept; rows of one doc_id with
different texts are told apart by their content.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalgrid.llm.common import content_key, free_name, numbered, stored, text_pieces
from vitalgrid.llm.textblock import TextBlock, mix

SHINGLE = 4
PERCENT = 80
COORDS = 64
MATCHES = 32
PIECE_BYTES = 1 << 20
NODE_CHUNKS = 1024


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    block = TextBlock(data, offsets, lower=True)
    hashes = block.word_hashes()
    first, gram = block.windows(hashes, width)
    at = np.searchsorted(first, block.word_at)
    out = []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if b > a:
            out.append(np.unique(gram[a:b]))
            continue
        whole = np.zeros(min(1, block.word_at[i + 1] - block.word_at[i]), np.uint64)
        for k, h in enumerate(hashes[block.word_at[i] : block.word_at[i + 1]]):
            whole = mix(whole + h + np.uint64(k + 1))
        out.append(whole)
    return out


def signatures(sets: list[np.ndarray], coords: int) -> np.ndarray:
    """Sets x coords, the least 32-bit hash of each set under each coordinate's function."""
    seeds = mix(np.arange(1, 2 * coords + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    out = np.empty((len(sets), coords), np.uint32)
    for k in range(coords):
        h = flat ^ seeds[k]
        h *= seeds[coords + k] | np.uint64(1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, k] = np.minimum.reduceat((h >> np.uint64(32)).astype(np.uint32), starts)
    return out


def sketches(docs: DataFrame, width: int = SHINGLE, coords: int = COORDS) -> DataFrame:
    """(doc_id, content, n_shingles, class_key, signature); key and signature are null for an empty set."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                sets = shingle_sets(data, offsets, width)
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full, coords)) if full else iter(())
                keys, sigs = [], []
                for s in sets:
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(next(signed).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, end - first) for c in ("doc_id", "content")), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "content", "n_shingles", "class_key", "signature"],
                )

    rows = docs.select("doc_id", content_key(F.col("text")).alias("content"), "text")
    return rows.mapInArrow(run, "doc_id long, content long, n_shingles long, class_key binary, signature binary")


def _postings(nodes: DataFrame, coords: int) -> DataFrame:
    """(key, node): key stands for one coordinate and one value of it."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sigs = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, coords)
                key = mix(np.arange(coords, dtype=np.uint64)[None, :] << np.uint64(32) | sigs).view(np.int64)
                node = np.repeat(np.asarray(part.column("node")), coords)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(node)], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def prefixes(nodes: DataFrame, coords: int, matches: int) -> DataFrame:
    """(key, node, score): each node under its rarest shared coordinates, as many as a candidate can't avoid.

    ``score`` is the number of agreements with other nodes: largest in the middle of a group.
    """
    postings = _postings(nodes, coords)
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(shared)  # apart from the join, so that it can split a frequent key
    lists = postings.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("own"))
    rarest = F.slice("own", 1, F.size("own") - (matches - 1))
    score = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    lists = lists.where(F.size("own") >= matches).select("node", score.alias("score"), F.explode(rarest).alias("x"))
    return lists.select("x.key", "node", "score")


def _exploded(sets: DataFrame) -> DataFrame:
    """(node, shingle)"""

    def run(batches):
        for batch in batches:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("shingles")):
                x = np.frombuffer(raw.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), node)), pa.array(x)], ["node", "shingle"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, shingle long")


def _shared_parts(sets: DataFrame) -> DataFrame:
    """(node, size, common): the size of each set and how many of its shingles another set has too."""
    rows = _exploded(sets)
    private = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("_node")).where("n = 1")
    private = private.groupBy("_node").agg(F.count(F.lit(1)).alias("own"))
    sized = sets.select("node", F.expr("octet_length(shingles) div 8").alias("size"))
    joined = sized.join(private, F.col("node") == F.col("_node"), "left")
    return joined.select("node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common"))


def _may_link(percent: int, s: str, c: str, t: str, d: str) -> Column:
    """Whether sets of sizes s, t with shared parts c, d can be as similar as that."""
    small, large = F.least(s, t), F.greatest(s, t)
    overlap = F.least(c, d) * (100 + percent) >= (F.col(s) + F.col(t)) * percent
    return (small * 100 >= large * percent) & overlap


def _like(pairs: DataFrame, nodes: DataFrame, matches: int) -> DataFrame:
    """The distinct pairs (a, b) whose signatures agree often enough."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                s, t = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(part.num_rows, -1) for c in ("s", "t")
                )
                good = pa.array((s == t).sum(1) >= matches)
                yield part.select(["a", "b"]).filter(good)

    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("s"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("t"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the wanted nodes: (node, doc_id, content) of one row of each class."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                sets = [s.tobytes() for s in shingle_sets(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, end - first), pa.array(sets, pa.binary())], ["node", "shingles"])

    rows = docs.select("doc_id", content_key(F.col("text")).alias("content"), "text").join(wanted, ["doc_id", "content"]).select("node", "text")
    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * |intersection| >= percent * |union|."""

    def run(batches):
        for batch in batches:
            good = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    # b is often a large group's smallest node: its set is joined last, where it isn't copied by the shuffle.
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with an edge can reach, by alternating stars."""

    def measure(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return tuple(r)

    def smaller(e: DataFrame) -> DataFrame:
        return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = stored(smaller(edges.toDF("u", "v")))
    seen = measure(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        now = stored(smaller(both.join(stored(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        least = stored(now.groupBy("u").agg(F.min("v").alias("m")))
        hung = now.join(least, "u")
        now = stored(smaller(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", "m"))))
        if (after := measure(now)) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = after


def _star(lists: DataFrame, percent: int) -> DataFrame:
    """Each node with the middle node of each of its lists."""
    middle = lists.groupBy("key").agg(F.max_by(F.struct("node", "size", "common"), F.struct("score", -F.col("node"))).alias("m"))
    middle = stored(middle.select("key", F.col("m.node").alias("b"), F.col("m.size").alias("t"), F.col("m.common").alias("d")))
    pairs = lists.join(middle, "key").where((F.col("node") != F.col("b")) & _may_link(percent, "size", "common", "t", "d"))
    return pairs.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()


def _met(lists: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a list and may be similar enough.

    Only nodes of lists with several components are left, and one of a pair is
    outside some list's largest component. Among them the rarest shingles decide (a
    prefix again, now of the sets): the first shingle that two sets have in common stands
    early enough in both to leave room for the overlap they need.
    """
    rows = lists.join(labels, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    rows = stored(rows)
    sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("major"), F.count(F.lit(1)).alias("_k"))
    major = stored(major.where("_k > 1").select("key", "major"))
    mixed = rows.join(major, "key").groupBy("node").agg(
        F.first("size").alias("size"), F.first("root").alias("root"), F.bool_or(F.col("root") != F.col("major")).alias("outside")
    )
    mixed = stored(mixed)
    shingles = stored(_exploded(mixed.join(sets.select("node", "shingles"), "node")))
    common = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = W.partitionBy("node")
    ranked = shingles.join(stored(common), "shingle").select(
        "node", "shingle", (F.row_number().over(own.orderBy("n", "shingle")) - 1).alias("at"), F.count(F.lit(1)).over(own).alias("common")
    )
    front = ranked.join(mixed, "node").where((F.col("common") - F.col("at")) * 100 >= F.col("size") * percent)
    front = stored(front)
    some = front.where("outside").select(
        "shingle", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("size").alias("t"), (F.col("common") - F.col("at")).alias("rest_x")
    )
    fits = F.least("rest_x", F.expr("common - at")) * (100 + percent) >= (F.col("size") + F.col("t")) * percent
    near = F.least("size", "t") * 100 >= F.greatest("size", "t") * percent
    pairs = some.join(front, "shingle").where(F.expr("rx <> root and (not outside or x < node)") & fits & near)
    return pairs.select(F.greatest("x", "node").alias("a"), F.least("x", "node").alias("b")).distinct()


def near_groups(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, coords: int = COORDS, matches: int = MATCHES
) -> DataFrame:
    """(doc_id, content, n_shingles, class_key, class_id, component_id, first): a row per document.

    ``class_id`` and ``component_id`` are the smallest doc_ids of the document's class and component. ``first`` is true for one
    (doc_id, content) of each component, the one to keep, and for what is linked with nothing.
    """
    drawn = stored(sketches(docs, width, coords))
    full = drawn.where("class_key is not null and doc_id is not null")
    classes = full.groupBy("class_key").agg(F.min(F.struct("doc_id", "content")).alias("own"))
    classes = classes.select("class_key", "own.doc_id", "own.content", F.pmod(F.xxhash64("class_key"), F.lit(NODE_CHUNKS)).alias("chunk"))
    classes = stored(numbered(stored(classes), [], ["class_key"], "node", "chunk").drop("chunk"))
    nodes = stored(full.join(classes, ["class_key", "doc_id", "content"]).select("node", "doc_id", "content", "signature").dropDuplicates(["node"]))
    lists = stored(prefixes(nodes, coords, matches))
    shared = stored(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    lists = stored(lists.join(shared, "key"))
    wanted = nodes.join(lists.select("node").distinct(), "node").select("node", "doc_id", "content")
    sets = stored(_sets(docs, wanted, width))
    parts = stored(_shared_parts(sets).where(F.col("common") * 100 >= F.col("size") * percent))
    lists = stored(lists.join(parts, "node"))
    links = stored(_confirmed(stored(_like(_star(lists, percent), nodes, matches)), sets, percent))
    rest = stored(_like(_met(lists, sets, components(links), percent), nodes, matches))
    more = stored(_confirmed(rest, sets, percent))
    named = classes.join(components(links.union(more)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stored(named)
    heads = named.groupBy("root").agg(F.min(F.struct("doc_id", "node", "content")).alias("head"))
    named = named.join(heads, "root").select(
        "class_key", F.col("doc_id").alias("class_id"), F.col("head.doc_id").alias("component_id"),
        F.col("head.content").alias("_content"), (F.col("head.node") == F.col("node")).alias("_head"),
    )
    out = drawn.join(stored(named), "class_key", "left")
    alone: Column = F.col("doc_id")
    own = F.when(F.col("doc_id").isNull(), None)
    first = F.col("_head") & (F.col("component_id") == alone) & (F.col("_content") == F.col("content"))
    return out.select(
        "doc_id", "content", "n_shingles", "class_key", own.otherwise(F.coalesce("class_id", alone)).alias("class_id"),
        own.otherwise(F.coalesce("component_id", alone)).alias("component_id"), F.coalesce(F.when(alone.isNull(), True), first, F.lit(True)).alias("first"),
    )


def drop_near_copies(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near copies; rows without words and without a doc_id stay.

    Only rows whose (doc_id, content) occurs again are compared with one another; of these the first by the hash of its columns stays.
    """
    found = stored(near_groups(docs, width, percent).select("doc_id", "content", "first", (F.col("n_shingles") > 0).alias("full")))
    mark, doc, own, place = (free_name(docs, f"_{n}") for n in ("content", "doc", "own", "place"))
    gone = found.where("not first").select(F.col("doc_id").alias(doc), F.col("content").alias(own)).distinct()
    again = found.where("first and full and doc_id is not null").groupBy(F.col("doc_id").alias(doc), F.col("content").alias(own))
    again = again.count().where("count > 1").select(doc, own)
    rows = docs.withColumn(mark, content_key(F.col("text")))
    same = (F.col("doc_id") == F.col(doc)) & (F.col(mark) == F.col(own))
    once = rows.join(gone.union(again), same, "left_anti")
    if again.isEmpty():
        return once.select(*docs.columns)
    order = F.xxhash64(*[F.to_json(F.struct(c)) for c in docs.columns if c.lower() not in ("doc_id", "text")], F.lit(0))
    number = F.row_number().over(W.partitionBy("doc_id", mark).orderBy(order))
    one = rows.join(again, same, "left_semi").withColumn(place, number).where(F.col(place) == 1)
    return once.select(*docs.columns).unionByName(one.select(*docs.columns))
