"""K-d tree sharding: near equal bytes per shard by recursive weighted medians.

A unit is a group of equal texts; only a group with over a 25th of a shard's
bytes is cut into up to 256 units. A node of the tree holds some shards. It is cut along its
widest metadata dimension (texts count by their rank among the distinct values; its range as a share of the whole table's range) where
the bytes on both sides match the numbers of shards. The cut is exact: 16 bits of
the key are fixed per pass from a histogram of at most 65,536 cells a node, so
that only cuts, one per node, reach the driver.

Defined cases: a null text weighs one byte like an empty one; a null in a dimension
comes first; equal rows are numbered one after the other; extra columns pass through;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from vitalgrid.llm.common import numbered, stored

SHARDS = 8
HEAVY_SHARE = 25  # a group is cut from 1/25 of a shard on
CUTS = 256
VALUE_BITS, HASH_BITS, STEP_BITS = 31, 31, 16
SLOT_ROWS = 200_000


def _number(df: DataFrame, name: str) -> Column | None:
    """An order-preserving number; None for texts, which are ranked."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.NumericType):
        number = F.col(name).cast("double")
        return F.when(F.isnan(number), None).otherwise(number)
    return F.unix_micros(F.col(name).cast("timestamp")).cast("double")


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a text column replaced by its value's place among the column's distinct values, NULL for NULL.

    Values are cut where the order itself cuts them into parts of equal size, whatever they begin with.
    """
    values = rows.select(F.col(name).alias("_v")).where("_v is not null").distinct()
    parts = stored(values.repartitionByRange("_v").withColumn("_c", F.spark_partition_id()))
    ranks = stored(numbered(parts, [], ["_v"], "_r", "_c").select("_v", F.col("_r").cast("double").alias("_r")))
    joined = rows.join(ranks, rows[name] == ranks["_v"], "left")
    return joined.select(*[F.col("_r").alias(name) if c == name else rows[c] for c in rows.columns])


def _plain(schema: T.StructType, name: str) -> Column:
    """A form of a column that can be hashed and ordered: what holds maps as text."""

    def holds_map(t: T.DataType) -> bool:
        inner = [t.elementType] if isinstance(t, T.ArrayType) else [f.dataType for f in t] if isinstance(t, T.StructType) else []
        return isinstance(t, T.MapType) or any(holds_map(x) for x in inner)

    return F.to_json(F.struct(name)) if holds_map(schema[name].dataType) else F.col(name)


def kd_shards(docs: DataFrame, dims: list[str], shards: int = SHARDS, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``docs`` without its text, with _size, _crc, shard and slot (its number in the shard, from 0).

    These replace columns of their names; all others pass through.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    outputs = {"text", "_size", "_crc", shard.lower(), slot.lower()}
    names = {f"c{i}": c for i, c in enumerate(c for c in docs.columns if c.lower() not in outputs)}
    numbers = [_number(docs, d) for d in dims]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for n, c in names.items()], (F.octet_length(text).cast("long") + 1).alias("_size"), F.crc32(text).alias("_crc"),
        F.unhex(F.md5(text)).alias("_text"), *[(F.col(d) if x is None else x).alias(f"_d{i}") for i, (d, x) in enumerate(zip(dims, numbers))],
    )
    kept = list(names)
    plain = [_plain(rows.schema, c) for c in kept]
    rows = stored(rows)
    for i, x in enumerate(numbers):
        if x is None:
            rows = stored(_ranked(rows, f"_d{i}"))
    ranges = rows.agg(
        F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("n"),
        *[f(f"_d{i}").alias(f"{f.__name__}{i}") for i in range(len(dims)) for f in (F.min, F.max)],
    ).first()
    total, n = ranges["bytes"] or 0, ranges["n"]
    # Groups beyond either bound: at most 2 * 25 * shards.
    heavy = (
        rows.groupBy("_text").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .where((F.col("_bytes") * shards * HEAVY_SHARE > total) | (F.col("_rows") * shards * HEAVY_SHARE > n))
        .select("_text", (F.col("_bytes") * shards * HEAVY_SHARE > total).alias("_heavy"))
    )
    salt = F.pmod(F.xxhash64(*plain, F.lit(0)), F.lit(CUTS))
    rows = rows.join(F.broadcast(heavy), "_text", "left")  # its size is bounded above
    rows = rows.withColumn("_sub", F.when(F.col("_heavy").isNull(), 0).otherwise(salt))
    # A group with many rows and few bytes is salted for the join only and stays together.
    apart = F.when(F.col("_heavy"), F.col("_sub")).otherwise(0)
    units = (
        rows.groupBy("_text", "_sub")
        .agg(F.sum("_size").alias("w"), F.max(apart).alias("apart"), *[F.min(f"_d{i}").alias(f"d{i}") for i in range(len(dims))])
    )
    mark = F.shiftrightunsigned(F.xxhash64("_text", "apart"), 64 - HASH_BITS)
    keys = []
    for i in range(len(dims)):
        low, high = ranges[f"min{i}"], ranges[f"max{i}"]
        scale = ((1 << VALUE_BITS) - 2) / (high - low) if high is not None and high > low else 0.0
        place = F.coalesce(F.floor((F.col(f"d{i}") - F.lit(low)) * F.lit(scale)) + 1, F.lit(0)) if low is not None else F.lit(0)
        keys.append((F.shiftleft(place.cast("long"), HASH_BITS) + mark).alias(f"k{i}"))
    if not keys:
        keys = [mark.cast("long").alias("k0")]
    units = stored(units.select("_text", "_sub", "w", *keys))
    placed = _split(units, len(keys), shards).select(F.col("_text").alias("_t"), F.col("_sub").alias("_s"), F.col("node").alias(shard))
    rows = rows.join(placed, (rows["_text"] == placed["_t"]) & (rows["_sub"] == placed["_s"]))
    out = rows.select(*kept, "_size", "_crc", "_text", shard)
    chunks = max(1, n // shards // SLOT_ROWS)
    out = out.withColumn("_chunk", F.pmod(F.xxhash64("_text", *plain), F.lit(chunks)))
    out = numbered(out, [shard], [*plain, "_text"], slot, "_chunk")
    return out.select(*[F.col(n).alias(c) for n, c in names.items()], "_size", "_crc", shard, slot)


def _at(values: list, kind: type) -> Column:
    """A column of one value per node, from a constant array: nodes are numbered from 0."""
    return F.get(F.lit(np.array(values, kind)), F.col("node"))


def _split(units: DataFrame, dims: int, shards: int) -> DataFrame:
    """``units`` with the column node: the shard, from 0."""
    units = units.withColumn("node", F.lit(0).cast("int"))
    parts = {0: shards}  # first shard of a node -> its number of shards
    while any(k > 1 for k in parts.values()):
        ends = [f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)]
        # Of the whole table at first; a node's range is compared with it.
        stats = {r["node"]: r for r in units.groupBy("node").agg(F.sum("w").alias("w"), *ends).collect()}  # a row per node
        if len(parts) == 1:
            whole = [max(1, stats[0][f"max{i}"] - stats[0][f"min{i}"]) for i in range(dims)] if 0 in stats else [1] * dims
        search: dict[int, dict] = {}
        for node, k in parts.items():
            if k > 1 and node in stats:
                r = stats[node]
                width = [(r[f"max{i}"] - r[f"min{i}"]) / whole[i] for i in range(dims)]
                dim = max(range(dims), key=lambda i: (width[i], -i))
                low, high = r[f"min{dim}"], r[f"max{dim}"]
                search[node] = {
                    "dim": dim, "low": low, "shift": max(0, (high - low).bit_length() - STEP_BITS), "high": high,
                    "want": r["w"] * (k // 2) // k, "done": 0, "cut": None,
                }
        while waiting := {n: s for n, s in search.items() if s["cut"] is None}:
            for node, cell, upto, w in _cells(units, waiting, dims):
                s = waiting[node]
                s["low"] += cell << s["shift"]
                s["high"] = min(s["high"], s["low"] + (1 << s["shift"]) - 1)
                s["done"] += upto - w
                s["want"] -= upto - w
                if s["shift"] == 0:
                    # The unit across the mark goes to the side it overlaps more.
                    s["cut"] = s["low"] if 2 * s["want"] >= w else s["low"] - 1
                s["shift"] = max(0, s["shift"] - STEP_BITS)
        grown = {}
        for node, k in parts.items():
            if k > 1:
                grown[node], grown[node + k // 2] = k // 2, k - k // 2
            else:
                grown[node] = k
        if search:
            at = [search.get(n) for n in range(shards)]
            key = _key_of([s["dim"] if s else -1 for s in at], dims)
            beyond = key > _at([s["cut"] if s else 0 for s in at], np.int64)
            right = _at([n + parts[n] // 2 if s else n for n, s in enumerate(at)], np.int32)
            units = units.withColumn("node", F.when(beyond, right).otherwise(F.col("node")))
        parts = grown
    return units


def _key_of(dims_by_node: list[int], dims: int) -> Column:
    """The key of each unit along its node's dimension, NULL for -1."""
    return F.get(F.array(*[f"k{i}" for i in range(dims)]), _at(dims_by_node, np.int32))


def _cells(units: DataFrame, search: dict[int, dict], dims: int) -> list[tuple[int, int, int, int]]:
    """(node, cell, bytes up to it, its bytes) of the cell in which each node reaches its mark."""
    at = [search.get(n) for n in range(max(search) + 1)]
    inside = units.where(_at([s is not None for s in at], np.int32) == 1).withColumns({
        "_key": _key_of([s["dim"] if s else -1 for s in at], dims),
        **{f"_{c}": _at([s[c] if s else 0 for s in at], np.int64) for c in ("low", "high", "shift", "want")},
    })
    cells = (
        inside.where("_key between _low and _high")
        .groupBy("node", F.expr("shiftright(_key - _low, cast(_shift as int))").alias("cell"))
        .agg(F.sum("w").alias("w"), F.max("_want").alias("_want"))
    )
    upto = F.sum("w").over(W.partitionBy("node").orderBy("cell"))
    reached = cells.withColumn("upto", upto).where("upto >= _want")
    best = reached.groupBy("node").agg(F.min_by(F.struct("cell", "upto", "w"), "cell").alias("b"))
    return [(r["node"], r["b"]["cell"], r["b"]["upto"], r["b"]["w"]) for r in best.collect()]
