"""Best-fit packing by length patterns.

Documents become token pieces of at most ``size`` tokens. Their length histogram,
``size`` counts at most, decides everything: patterns of up to three length classes that
fill a sequence are enumerated, non-negative least squares fits how often each
is repeated, the rounded repeats take their pieces, and what is left is packed
best-fit, longest first. The plan is a list of rank intervals per length; pieces
are numbered within their length and look their place up in it.

Defined cases: a null or empty text is one piece with the end token; equal rows
are packed each for itself; a null doc_id is kept; no documents give no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from vitalgrid.llm.bpe import blocks, byte_symbols
from vitalgrid.llm.chunks import ChunkCache, specials
from vitalgrid.llm.common import numbered
from vitalgrid.session import materialize

SIZE = 2048
END_ID = 0
CLASSES = 512
CHUNK_ROWS = 100_000
BLOCK_BYTES = 8 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: The fields of a file whose words may be encoded in one text, and their values.
_PLAIN = {"dropout": None, "unk_token": None, "continuing_subword_prefix": "", "end_of_word_suffix": "", "byte_fallback": False, "ignore_merges": False}


def _separator(file: dict, symbols: dict[int, str]) -> str | None:
    """The symbol of a byte that no text holds and no merge has, if words parted by it are encoded as each for itself."""
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    if file.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    if any((model.get(k) or None) != (v or None) for k, v in _PLAIN.items()):
        return None
    merged = {s for m in model["merges"] for s in (m.split(" ") if isinstance(m, str) else m)}
    unused = (symbols[b] for b in (0xC0, 0xC1, *range(0xF5, 0x100)))
    return next((s for s in unused if s in model["vocab"] and s not in merged), None)


def library_cache(tokenizer_json: str) -> ChunkCache:
    """Words encoded by the tokenizers library, each distinct one once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core already
    from tokenizers import Tokenizer

    file = json.loads(tokenizer_json)
    symbols = {b: c for c, b in byte_symbols().items()}
    mark = _separator(file, symbols)
    if mark is None:
        tokenizer = Tokenizer.from_str(tokenizer_json)
        return ChunkCache(
            lambda words: [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)],
            *specials(tokenizer_json),
        )

    # The words are there already, so that the library gets many in one text, in the vocabulary's symbols.
    tokenizer = Tokenizer.from_str(json.dumps(file | {"pre_tokenizer": None, "post_processor": None, "added_tokens": []}))
    mark_id = file["model"]["vocab"][mark]
    apart = chr(0xDC00 + next(b for b, c in symbols.items() if c == mark))  # becomes this byte

    def encode(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for first in range(0, len(words), 256):
            raw = apart.join(words[first : first + 256]).encode("utf-8", "surrogateescape")
            text = raw.decode("latin-1").translate(symbols)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            data, ends = ids.tobytes(), [*(np.flatnonzero(ids == mark_id) * 4).tolist(), len(ids) * 4]
            out += [data[i:j] for i, j in zip([0, *(e + 4 for e in ends)], ends)]
        return out

    return ChunkCache(encode, *specials(tokenizer_json))


_CACHES: dict[int, ChunkCache] = {}


def token_pieces(docs: DataFrame, tokenizer_json: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``size`` tokens; only the first piece of a document may be shorter than the others."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one file of a few megabytes
    end = end_id.to_bytes(4, "little")

    def run(batches):
        key = zlib.crc32(shipped.value.encode())
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = library_cache(shipped.value)
        cache = _CACHES[key]
        for block in blocks(batches, "text", BLOCK_BYTES):
            rows = []
            found = cache.ids_of(block.column("text").combine_chunks().fill_null(""))
            for doc, ids in zip(block.column("doc_id").to_pylist(), found):
                ids += end
                n = len(ids) // 4
                first = (n - 1) % size + 1
                cuts = [0, *range(first, n + 1, size)]
                rows += [
                    (doc, k, a, b - a, zlib.crc32(memoryview(ids)[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def patterns(classes: int) -> np.ndarray:
    """All multisets of one to three classes 1..n that sum to n, as rows padded with 0."""
    a = np.arange(1, classes + 1)
    x, y = np.meshgrid(a, np.arange(0, classes + 1), indexing="ij")
    z = classes - x - y
    ok = (x >= y) & (y >= z) & (z >= 0)
    return np.stack([x[ok], y[ok], z[ok]], 1)


def nnls(cols: np.ndarray, want: np.ndarray, rounds: int = 4000) -> np.ndarray:
    """x >= 0 with least squares of A x - want, by active sets.

    Column j of A counts the classes in ``cols[j]``; class 0 is padding. The active
    columns stay independent, so no more of them are positive than there are classes.
    """
    n, m = len(want), len(cols)
    x = np.zeros(m)
    active: list[int] = []
    scale = max(1.0, float(want.max(initial=0)))
    target = want / scale

    def columns(js: list[int]) -> np.ndarray:
        out = np.zeros((n, len(js)))
        for k in range(3):
            np.add.at(out, (cols[js, k], np.arange(len(js))), 1.0)
        out[0] = 0
        return out

    matrix = np.zeros((n, 0))
    step = 32
    for _ in range(rounds):
        rest = target - matrix @ x[active]
        rest[0] = 0
        gain = rest[cols].sum(1)
        gain[active] = -1
        best = np.argpartition(-gain, min(step, m - 1))[:step] if step > 1 else np.array([gain.argmax()])
        best = best[gain[best] > 1e-7]
        if not len(best):
            if step == 1:
                break
            step = 1
            continue
        before = float(rest @ rest)
        active += best.tolist()
        matrix = columns(active)
        while active:
            fit = np.linalg.solve(matrix.T @ matrix + 1e-10 * np.eye(len(active)), matrix.T @ target)
            now = x[active]
            low = fit <= 0
            if not low.any():
                x[active] = fit
                break
            ratio = np.min(now[low] / np.maximum(now[low] - fit[low], 1e-300))
            moved = now + ratio * (fit - now)
            x[active] = np.maximum(moved, 0)
            stay = ~(low & (moved <= 1e-12))
            for j, s in zip(active, stay):
                if not s:
                    x[j] = 0
            active = [j for j, s in zip(active, stay) if s]
            matrix = matrix[:, stay]
        after = target - matrix @ x[active]
        after[0] = 0
        if before - float(after @ after) < 1e-7 * float(target @ target):
            if step == 1:
                break
            step = max(1, step // 4)
    return x * scale


def fitted_repeats(counts: np.ndarray, classes: int) -> list[tuple[tuple[int, ...], int]]:
    """(classes of a pattern, repeats), never using more of a class than there is."""
    cols = patterns(classes)
    cols = cols[((counts[cols] > 0) | (cols == 0)).all(1)]
    if not len(cols):
        return []
    x = nnls(cols, counts.astype(float))
    left = counts.copy()
    found = []
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        parts = tuple(int(c) for c in cols[j] if c)
        most = min(int(left[c]) // parts.count(c) for c in set(parts))
        times = min(int(x[j] + 0.5), most)
        if times:
            found.append((parts, times))
            for c in parts:
                left[c] -= times
    return found


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram of lengths, a group of equal sequences at a time."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # free tokens -> sequences
    rooms = np.zeros(size + 1, bool)
    for length in range(size, 0, -1):
        n = int(counts[length])
        while n:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                parts, times = open_[room].pop()
                if not open_[room]:
                    rooms[room] = False
            else:
                room, parts, times = size, (), n
            each = min(room // length, n)
            used = min(times, n // each)
            if used < times and parts:
                open_[room].append((parts, times - used))
                rooms[room] = True
            rest = room - each * length
            open_[rest].append((parts + (length,) * each, used))
            rooms[rest] = True
            n -= each * used
    return [x for group in open_.values() for x in group]


def plan(counts: np.ndarray, size: int, classes: int = CLASSES) -> np.ndarray:
    """Rank intervals (length, first rank, sequence of the first rank, place), sorted.

    ``counts[n]`` pieces have length n. A piece of this length with a rank from the
    interval goes to sequence + (rank - first rank).
    """
    classes = min(classes, size)
    width = -(-size // classes)
    class_of = -(-np.arange(size + 1) // width)
    top = int(class_of.max())
    by_class = np.bincount(class_of, counts, top + 1).astype(np.int64)
    by_class[0] = 0
    used = np.zeros(size + 1, np.int64)
    out: list[tuple[int, int, int, int]] = []
    sequence = 0
    wanted: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # class -> (sequence, place, repeats)
    for parts, times in fitted_repeats(by_class, top):
        for place, c in enumerate(parts):
            wanted[c].append((sequence, place, times))
        sequence += times
    for c, slots in wanted.items():
        lengths = [n for n in range(min(size, c * width), (c - 1) * width, -1) if counts[n]]
        for first, place, times in slots:
            while times:  # the longest of a class first: they leave the least room
                n = lengths[0]
                took = min(times, int(counts[n] - used[n]))
                if took:
                    out.append((n, int(used[n]), first, place))
                    used[n] += took
                    first, times = first + took, times - took
                if used[n] == counts[n]:
                    lengths.pop(0)
    for parts, times in best_fit(counts - used, size):
        for place, n in enumerate(parts):
            out.append((n, int(used[n]), sequence, place))
            used[n] += times
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, size: int = SIZE, classes: int = CLASSES) -> DataFrame:
    """``pieces`` with sequence_id and the offset there."""
    spark = pieces.sparkSession
    pieces = materialize(pieces)  # tokens are counted and packed from one and the same copy
    counts = np.zeros(size + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[length] = n
    if not counts.sum():
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = plan(counts, size, classes)
    key = places[:, 0] << 44 | places[:, 1]
    shipped = spark.sparkContext.broadcast((key, places))  # bounded by the classes and the plan's steps, not by pieces

    def locate(batches):
        key, places = shipped.value
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            seq = places[at, 2] + rank - places[at, 1]
            kept = batch.select([n for n in batch.schema.names if n != "rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(seq), pa.array(places[at, 3])], [*kept.schema.names, "sequence_id", "place"]
            )

    chunks = max(1, int(counts.max()) // CHUNK_ROWS)
    ranked = numbered(
        pieces.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks))),
        ["length"], ["doc_id", "piece", "ids_crc32"], "rank", "_chunk",
    ).drop("_chunk")
    placed = ranked.mapInArrow(locate, f"{PIECE_SCHEMA}, sequence_id long, place long")
    before = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("place")


def pack_documents(docs: DataFrame, tokenizer_json: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_json, size, end_id), size)
