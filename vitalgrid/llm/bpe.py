"""BPE encoding and decoding with a pair occurrence index.

The distinct new words of a block of texts lie in one array of symbols. An index
maps each mergeable pair to all its positions; ranks are applied in ascending
order, each to all its positions at once, and only the lists of pairs that touch
a merge change. A merge's result can only occur in later merges, so one ascending
pass is complete.

Defined cases: a null or empty text has no tokens; the special token's text
becomes its id; extra columns are left out of the digest and kept by ``encoded``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, types as T

from vitalgrid.llm.chunks import ChunkCache, specials

BLOCK_BYTES = 8 << 20


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndex:
    """Merge tables of one vocabulary."""

    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)["model"]
        vocab, symbols = model["vocab"], byte_symbols()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        special, special_id = specials(tokenizer_json)
        size = max([*vocab.values(), special_id or 0]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(symbols.__getitem__, token))
        if special is not None:
            self.bytes[special_id] = special.encode()
        self.decimal = [str(i).encode() for i in range(size)]
        self.byte_id = np.zeros(256, np.int64)
        for token, b in symbols.items():
            self.byte_id[b] = vocab[token]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.size = size
        keys = self.left * size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.cache = ChunkCache(self.encode_words, special, special_id)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it cannot be merged."""
        want = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.rank_of[at], -1)

    def encode_words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        n = int(lengths.sum())
        ends = np.cumsum(lengths)
        sym = np.full(n + 1, -1, np.int64)  # the last entry stands for "nothing there"
        sym[:n] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        nxt[ends[lengths > 0] - 1] = n
        prv[(ends - lengths)[lengths > 0]] = n
        prv[n] = nxt[n] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def post(at: np.ndarray) -> None:
            rank = self.ranks(sym[at], sym[nxt[at]])
            good = rank >= 0
            at, rank = at[good], rank[good]
            if len(at) > 1:
                order = np.argsort(rank, kind="stable")
                at, rank = at[order], rank[order]
            cuts = [0, *(np.flatnonzero(np.diff(rank)) + 1).tolist(), len(at)] if len(at) else [0]
            for i, j in zip(cuts, cuts[1:]):
                r = int(rank[i])
                if r in index:
                    index[r].append(at[i:j])
                else:
                    index[r] = [at[i:j]]
                    heapq.heappush(active, r)

        first = np.arange(n)
        post(first[nxt[:n] < n])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, t = self.left[r], self.right[r], self.made[r]
            at = at[(sym[at] == a) & (sym[nxt[at]] == b)]
            if a == b and len(at) > 1:
                at = self._apart(np.sort(at), nxt)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at], sym[gone] = t, -1
            nxt[at] = after
            prv[after] = at
            prv[n] = n
            before = prv[at]
            # A merged neighbour in front posts the pair between the two itself.
            before = before[(before < n) & (sym[before] != t)]
            at = at[after < n]
            post(np.concatenate((at, before)))
        alive = sym[:n] >= 0
        ids = sym[:n][alive].astype("<u4").tobytes()
        counts = np.concatenate(([0], np.cumsum(alive)))
        cuts = (counts[np.concatenate(([0], ends))] * 4).tolist()
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of a run of overlapping occurrences every second one, from the left."""
        keep, taken = [], -1
        for i, follows in zip(at.tolist(), nxt[at].tolist()):
            if i != taken:
                keep.append(i)
                taken = follows
        return np.array(keep, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self.cache.ids_of(texts)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec(tokenizer_json: str) -> PairIndex:
    return PairIndex(tokenizer_json)


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Batches joined to, or cut into, blocks of about ``size`` bytes of text."""
    held: list[pa.RecordBatch] = []
    room = size
    for batch in batches:
        lengths = np.asarray(pa.compute.binary_length(batch.column(text)).fill_null(0)).astype(np.int64)
        sums, first = np.cumsum(lengths), 0
        while first < len(lengths):
            done = sums[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(sums, done + room, "right")))
            held.append(batch.slice(first, end - first))
            room -= int(sums[end - 1] - done)
            first = end
            if room <= 0 or end < len(lengths):
                yield pa.Table.from_batches(held)
                held, room = [], size
    if held:
        yield pa.Table.from_batches(held)


def _shipped(docs: DataFrame, tokenizer_json: str):
    return docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one file of a few megabytes


def encoded(docs: DataFrame, tokenizer_json: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as an array, which replaces a column of its name."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower()])
    shipped = _shipped(docs, tokenizer_json)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        c = codec(shipped.value)
        for block in blocks(batches, text):
            ids = c.encode([x or "" for x in block.column(text).to_pylist()])
            arrays = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            yield from block.append_column(out, arrays).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Per document: number of ids, hash of the ids, hash of what they decode to."""
    shipped = _shipped(docs, tokenizer_json)

    def run(batches):
        c = codec(shipped.value)
        decimal, sha = c.decimal.__getitem__, hashlib.sha256
        for block in blocks(batches, "text"):
            rows = []
            for ids in c.encode([x or "" for x in block.column("text").to_pylist()]):
                ids = ids.tolist()
                rows.append((len(ids), sha(b",".join(map(decimal, ids))).hexdigest(), sha(c.decode(ids).encode()).hexdigest()))
            n, a, b = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
