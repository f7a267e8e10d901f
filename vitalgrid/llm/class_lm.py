"""Brown class-based bigram model: exchange clustering, smoothed transitions and emissions.

log P(text) = sum of log P(class | class before) + log P(word | class) over the words and the
end token. Every training token counts. Classes begin with units: words of ``LEAST`` tokens and a
share of ``FREQUENT`` or more (at most 1 / FREQUENT words) are units of their own, every other
word belongs to the unit of its ending (``ENDINGS`` units). Exchange clustering deals the units to
classes: in a sweep each unit of one third moves to the class that raises the likelihood of the
class bigrams most. Then every other word, however rare, is inserted by its own
neighbours into the class that makes them most likely; its ending's class counts as ``PRIOR`` nats
of evidence. The class bigrams are counted again over all words' own classes. The number
of classes is half the cube root of the vocabulary, ``CLASSES`` at least. Counts of words, unit
pairs and contexts are Spark aggregations; what is broadcast is bounded by these
parameters and the classes.

Emissions are add-one over a class's words and one unknown word, so rare words need
their exact counts. A block of documents asks for the counts and classes of its rare words once:
(word, block) rows carry the places of the word, meet them, and go back by block. A word
without a training token has its ending's class.

Words are told apart by 64-bit hashes. Defined cases: a null or empty text is the end token
alone; a null doc_id counts as the text '' for the fold; equal rows get equal
scores; without training documents every token is unknown.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.llm.common import stored, text_pieces
from vitalgrid.llm.textblock import TextBlock, mix

FREQUENT = 1e-5
LEAST = 100  # tokens of a word that is a unit
ENDINGS = 1024
CLASSES = 32  # at least
PRIOR = 3.0
SWEEPS = 9
FOLDS, HELD_FOLD = 7, 2
PIECE_BYTES = 1 << 20
BLOCK_BYTES = 12 << 20
BLOCK_DOCS = 60_000
#: Tokens whose requests one task answers, and whose answers one task gathers.
TOKENS_PER_TASK = 1 << 20


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[TextBlock, np.ndarray, np.ndarray]:
    """(block, word hashes, units of their endings)."""
    block = TextBlock(data, offsets, lower=True)
    ending = block.hashes(np.maximum(block.starts, block.ends - 3), block.ends) % np.uint64(ENDINGS)
    return block, block.word_hashes().view(np.int64), ending.astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sum the counts (last) of equal keys (first); other columns follow from the key."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    key, at, inverse = np.unique(columns[0], return_index=True, return_inverse=True)
    total = np.bincount(inverse, columns[-1], len(key)).astype(np.int64)
    return (key, *[c[at] for c in columns[1:-1]], total)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, ending, c): all words of the training documents."""

    def run(batches):
        parts: list[tuple[np.ndarray, ...]] = []

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _summed(parts)], ["word", "ending", "c"])
            parts.clear()

        for batch in batches:
            for _, _, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                _, word, ending = _words(data, offsets)
                parts.append(_summed([(word, ending, np.ones(len(word), np.int64))]))
                if len(parts) >= BLOCK_BYTES // PIECE_BYTES:
                    yield from flush()
        if parts:
            yield from flush()

    rows = train.select("text").mapInArrow(run, "word long, ending long, c long")
    return stored(rows.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("c").alias("c")))


@dataclass
class Units:
    """Frequent words, then endings, then the end token."""

    words: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray  # theirs
    tokens: np.ndarray  # of each unit
    kinds: np.ndarray  # distinct words of each unit

    @property
    def size(self) -> int:
        return len(self.words) + ENDINGS + 1

    def of(self, word: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit of each word, whether it is a frequent one)."""
        if not len(self.words):
            return ending, np.zeros(len(word), bool)
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        hit = self.words[at] == word
        return np.where(hit, at, len(self.words) + ending), hit


def units_of(counts: DataFrame, n_docs: int, frequent: float = FREQUENT) -> tuple[Units, int, int]:
    """(units, training tokens, distinct training tokens), the end token included."""
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = (totals["n"] or 0) + n_docs, totals["v"] + (n_docs > 0)
    top = counts.where(F.col("c") >= max(LEAST, frequent * n)).select("word", "ending", "c").collect()  # at most 1 / frequent rows
    top.sort(key=lambda r: r["word"])
    words, own = (np.array([r[k] for r in top], np.int64) for k in ("word", "c"))
    tokens, kinds = np.zeros(len(top) + ENDINGS + 1, np.int64), np.zeros(len(top) + ENDINGS + 1, np.int64)
    for r in counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect():  # ENDINGS rows
        tokens[len(top) + r["ending"]], kinds[len(top) + r["ending"]] = r["c"], r["k"]
    for i, r in enumerate(top):
        tokens[i], kinds[i] = r["c"], 1
        tokens[len(top) + r["ending"]] -= r["c"]
        kinds[len(top) + r["ending"]] -= 1
    tokens[-1], kinds[-1] = n_docs, 1
    return Units(words, own, tokens, kinds), n, v


def _chain(block: TextBlock, unit: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit before, unit) of every token, end tokens included; also the end's places are the words' + texts before."""
    sizes = np.diff(block.word_at)
    now = np.full(len(unit) + block.n, end, np.int64)
    word_places = np.arange(len(unit)) + block.doc_of_word
    now[word_places] = unit
    before = np.empty_like(now)
    before[1:] = now[:-1]
    if len(before):
        before[np.cumsum(np.concatenate(([0], sizes[:-1] + 1)))] = end
    return before, now


def unit_pairs(train: DataFrame, units: Units) -> DataFrame:
    """(a, b, n): how often unit b follows unit a; a text begins after an end token."""
    size = units.size

    def run(batches):
        parts: list[tuple[np.ndarray, ...]] = []

        def flush():
            pair, n = _summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array((pair // size).astype(np.int32)), pa.array((pair % size).astype(np.int32)), pa.array(n)], ["a", "b", "n"])
            parts.clear()

        for batch in batches:
            for _, _, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                block, word, ending = _words(data, offsets)
                before, now = _chain(block, units.of(word, ending)[0], size - 1)
                parts.append(_summed([(before * size + now, np.ones(len(now), np.int64))]))
                if len(parts) >= BLOCK_BYTES // PIECE_BYTES:
                    yield from flush()
        if parts:
            yield from flush()

    rows = train.select("text").mapInArrow(run, "a int, b int, n long")
    return stored(rows.groupBy("a", "b").agg(F.sum("n").alias("n")))


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_class(moved: np.ndarray, right: np.ndarray, left: np.ndarray, own: float, now: int) -> tuple[int, float]:
    """The class a unit should be in and what that gains over staying.

    ``moved``: class bigram counts; ``right``/``left``: the unit's counts before and behind each
    class; ``own``: how often it follows itself.
    """
    k = len(moved) - 1  # the last class is the end token's alone
    right, left = right.copy(), left.copy()
    right[now] -= own
    left[now] -= own
    rest = moved.astype(float).copy()
    rest[now] -= right
    rest[:, now] -= left
    rest[now, now] -= own
    diagonal = np.arange(len(moved))
    # What others have before or behind the unit stays in their sums wherever the unit goes.
    rows, cols = rest.sum(1) + left, rest.sum(0) + right
    gain = (_f(rest + right[None, :]) - _f(rest)).sum(1) + (_f(rest + left[:, None]) - _f(rest)).sum(0)
    d = rest[diagonal, diagonal]
    gain += _f(d + right + left + own) - _f(d + right) - _f(d + left) + _f(d)
    gain -= _f(rows + right.sum() + own) - _f(rows) + _f(cols + left.sum() + own) - _f(cols)
    best = int(gain[:k].argmax())
    return best, float(gain[best] - gain[now])


def exchange(pairs: DataFrame, units: Units, classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigram counts). Units begin dealt round by falling count."""
    spark, size = pairs.sparkSession, units.size
    order = np.argsort(-units.tokens[:-1], kind="stable")
    now = np.empty(size, np.int32)
    now[order] = np.arange(size - 1) % classes
    now[-1] = classes
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for sweep in range(sweeps + 1):
        # A row per unit: bounded by 1 / FREQUENT and ENDINGS.
        table = spark.createDataFrame(list(enumerate(now.tolist())), "u int, c int")
        right = pairs.join(F.broadcast(table.toDF("b", "c")), "b").groupBy(F.col("a").alias("u"), F.lit(0).alias("side"), "c")
        left = pairs.join(F.broadcast(table.toDF("a", "c")), "a").groupBy(F.col("b").alias("u"), F.lit(1).alias("side"), "c")
        total = F.sum("n").alias("n")
        right = stored(right.agg(total))
        moved = np.zeros((classes + 1, classes + 1))
        for r in right.join(F.broadcast(table.toDF("u", "own")), "u").groupBy("own", "c").agg(total).collect():  # classes squared
            moved[r["own"], r["c"]] = r["n"]
        value = float(_f(moved).sum() - _f(moved.sum(0)).sum() - _f(moved.sum(1)).sum())
        if best is None or value > best[0]:
            gained = np.inf if best is None else (value - best[0]) / max(1.0, abs(best[0]))
            best = value, now.copy(), moved
        else:
            gained = 0.0
        if sweep == sweeps or (sweep >= 3 and gained < 1e-6):
            break
        alone = pairs.where("a = b").select(F.col("a").alias("u"), F.lit(2).alias("side"), F.lit(0).alias("c"), "n")
        third = F.pmod(F.xxhash64("u"), F.lit(3)) == sweep % 3
        rows = right.union(left.agg(total)).union(alone).where(third & (F.col("u") < size - 1))
        rows = rows.groupBy("u").agg(F.collect_list(F.struct("side", "c", "n")).alias("x"))  # a few per class

        def run(batches, moved=moved, now=now):
            for batch in batches:
                us, cs = [], []
                for u, x in zip(batch.column("u").to_pylist(), batch.column("x").to_pylist()):
                    sides = np.zeros((3, classes + 1))
                    for e in x:
                        sides[e["side"], e["c"]] = e["n"]
                    c, gain = best_class(moved, sides[0], sides[1], sides[2, 0], int(now[u]))
                    if gain > 1e-9:
                        us.append(u)
                        cs.append(c)
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int32()), pa.array(cs, pa.int32())], ["u", "c"])

        changes = rows.mapInArrow(run, "u int, c int").collect()  # a row per unit at most
        for r in changes:
            now[r["u"]] = r["c"]
    return best[1], best[2]


def classes_for(v: int) -> int:
    """Classes for ``v`` distinct words: their bigrams stay fewer than the words."""
    return max(CLASSES, math.ceil(v ** (1 / 3) / 2))


def inserted(train: DataFrame, units: Units, classes: np.ndarray, moved: np.ndarray) -> DataFrame:
    """(word, cls, c): every word that is no unit of its own, in the class its neighbours' classes make most likely."""
    k, end = len(moved), units.size - 1

    def contexts(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            word, home, left, right = (np.concatenate(c) for c in zip(*held))
            key, at, inverse = np.unique(word, return_index=True, return_inverse=True)
            first = inverse * (2 * k)
            slot, n = np.unique(np.concatenate((first + left, first + k + right)), return_counts=True)
            cuts = np.searchsorted(slot, np.arange(len(key) + 1) * (2 * k)) * 8
            data = np.stack((slot % (2 * k), n), 1).astype("<u4")
            near = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(home[at]), near], ["word", "home", "near"])
            held.clear()

        for batch in batches:
            for _, _, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                block, word, ending = _words(data, offsets)
                unit, frequent = units.of(word, ending)
                now = classes[_chain(block, unit, end)[1]]
                at = (np.arange(len(unit)) + block.doc_of_word)[~frequent]
                # Behind each text's end token the next text begins; the first text begins after one as well.
                held.append((word[~frequent], now[at], np.concatenate(([k - 1], now))[at], now[at + 1]))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    before = np.log((moved + 1) / (moved.sum(0) + k))
    behind = np.log((moved + 1) / (moved.sum(1, keepdims=True) + k)).T
    logs = np.concatenate((before, behind))[:, : k - 1]
    step = max(1, (1 << 21) // (2 * k))

    def choose(batches):
        """Rows come in the order of the words; a word's last row may be in a later batch."""
        held = None

        def put(word, home, seen):
            score = seen @ logs
            score[np.arange(len(word)), home] += PRIOR
            c = seen[:, :k].sum(1).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(score.argmax(1).astype(np.int32)), pa.array(c)], ["word", "cls", "c"])

        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                word, home = np.asarray(part.column("word")), np.asarray(part.column("home"))
                raw = part.column("near").to_pylist()
                slot, n = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64).T
                fresh = np.append(True, word[1:] != word[:-1])
                row = np.repeat(np.cumsum(fresh) - 1, np.fromiter(map(len, raw), np.int64, len(raw)) // 8)
                word, home = word[fresh], home[fresh]
                seen = np.bincount(row * (2 * k) + slot, n, len(word) * 2 * k).reshape(-1, 2 * k)
                if held is not None and held[0][0] == word[0]:
                    seen[0] += held[2][0]
                elif held is not None:
                    word, home, seen = (np.concatenate(c) for c in zip(held, (word, home, seen)))
                held = word[-1:], home[-1:], seen[-1:].copy()
                if len(word) > 1:
                    yield put(word[:-1], home[:-1], seen[:-1])
        if held is not None:
            yield put(*held)

    rows = train.select("text").mapInArrow(contexts, "word long, home int, near binary")
    return rows.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "word long, cls int, c long")


@dataclass
class Model:
    moves: np.ndarray  # log10 P(class | class before)
    emits: np.ndarray  # log10 of a class's emission denominator
    n: int
    v: int
    n_docs: int


def fit(docs: DataFrame, train: Column) -> tuple[Model, DataFrame]:
    """(model, word counts) of the documents for which ``train`` holds."""
    return _fitted(docs.select("doc_id", "text", (~train).alias("held")))[:2]


def _fitted(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """(model, word counts, blocks of all documents with every token's class)."""
    rows = docs.where(~F.col("held"))
    n_docs = rows.count()
    counts = word_counts(rows)
    units, n, v = units_of(counts, n_docs)
    classes, moved = exchange(unit_pairs(rows, units), units, classes_for(v))
    k, own = len(moved), len(units.words)
    words = stored(inserted(rows, units, classes, moved))
    tokens, kinds = (np.bincount(classes[:own], x[:own], k) for x in (units.tokens, units.kinds))
    for r in words.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect():  # a row per class
        tokens[r["cls"]] += r["c"]
        kinds[r["cls"]] += r["k"]
    blocks = stored(_resolved(docs, units, classes, words, n))
    moved = _class_pairs(blocks, k)
    moves = np.log10((moved + 1) / (moved.sum(1, keepdims=True) + k))
    emits = np.log10(tokens + kinds + 1)
    emits[-1] = 0.0  # the end token is all of its class
    return Model(moves, emits, n, v, n_docs), counts, blocks


_META = 6  # numbers per document: id, id is null, held out, words, known words, the logs of their counts


def _requests(docs: DataFrame, units: Units, classes: np.ndarray) -> DataFrame:
    """(word, block, places): a row per rare word and block; a block's own row has no word's key.

    Places count the block's tokens, end tokens included. The own row holds the number of
    documents, their numbers, and the class of each token's unit.
    """
    end = units.size - 1
    logs = np.log10(units.counts + 1.0)

    def run(batches):
        part = TaskContext.get().partitionId()
        serial, held, n_docs, n_tokens, size = 0, [], 0, 0, 0
        meta: list[np.ndarray] = []
        kinds: list[np.ndarray] = []

        def flush():
            nonlocal serial, n_docs, n_tokens, size
            block = part << 24 | serial
            word, place = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(word, kind="stable")
            word, place = word[order], place[order].astype("<u4")
            key, first = np.unique(word, return_index=True)
            cuts = np.append(first, len(word)) * 4
            facts = np.concatenate(meta, 1)
            whole = np.int64(n_docs).tobytes() + facts.tobytes() + np.concatenate(kinds).astype("<u2").tobytes()
            offsets = np.append(cuts, cuts[-1] + len(whole)).astype(np.int32)
            data = pa.py_buffer(place.tobytes() + whole)
            keys = np.append(key, mix(np.array([block], np.uint64)).view(np.int64))
            places = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets.tobytes()), data])
            own = np.zeros(len(keys), bool)
            own[-1] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.full(len(keys), block)), pa.array(own), places], ["word", "block", "own", "places"]
            )
            held.clear()
            meta.clear()
            kinds.clear()
            serial, n_docs, n_tokens, size = serial + 1, 0, 0, 0

        for batch in batches:
            for first, stop, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                for a in range(0, stop - first, BLOCK_DOCS):
                    b = min(stop - first, a + BLOCK_DOCS)
                    if n_docs + b - a > BLOCK_DOCS:
                        yield from flush()
                    block, word, ending = _words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    unit, frequent = units.of(word, ending)
                    ids = batch.column("doc_id").slice(first + a, b - a)
                    facts = np.zeros((_META, b - a))
                    facts[0] = np.asarray(ids.fill_null(0)).astype(np.int64).view(np.float64)
                    facts[1] = np.asarray(ids.is_null())
                    facts[2] = np.asarray(batch.column("held").slice(first + a, b - a))
                    facts[3] = np.diff(block.word_at)
                    doc = block.doc_of_word
                    facts[4] = np.bincount(doc[frequent], minlength=b - a)
                    facts[5] = np.bincount(doc[frequent], logs[unit[frequent]], b - a) if len(logs) else 0
                    meta.append(facts)
                    kinds.append(classes[_chain(block, unit, end)[1]])
                    held.append((word[~frequent], (np.arange(len(unit)) + doc)[~frequent] + n_tokens))
                    n_docs += b - a
                    n_tokens += len(kinds[-1])
                    size += int(offsets[b] - offsets[a])
                    if size >= BLOCK_BYTES:
                        yield from flush()
        if meta:
            yield from flush()

    return docs.mapInArrow(run, "word long, block long, own boolean, places binary")


GATHER_ROWS = 200_000


def _gathered(batches):
    """One row for all words of a block that a task has met: (block, own, counts, places).

    ``counts`` holds the words' counts, then their classes, then how many places each has;
    words of the same count and class are put together.
    """
    names = ["block", "own", "counts", "places"]
    held: list[pa.RecordBatch] = []
    rows = 0

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        block, c, cls = (np.asarray(table[n]) for n in ("block", "c", "cls"))
        places = table["places"].to_pylist()
        sizes = np.fromiter(map(len, places), np.int64, len(places)) // 4
        order = np.lexsort((cls, c, block))
        cuts = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), len(order)]
        out = []
        for i, j in zip(cuts, cuts[1:]):
            at = order[i:j]
            fresh = np.append(True, (np.diff(c[at]) != 0) | (np.diff(cls[at]) != 0))
            total = np.bincount(np.cumsum(fresh) - 1, sizes[at]).astype(np.int64)
            head = np.concatenate((c[at][fresh], cls[at][fresh].astype(np.int64), total))
            out.append((int(block[at[0]]), False, head.tobytes(), b"".join([places[k] for k in at])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.binary(), pa.binary()))], names
        )
        held.clear()

    for batch in batches:
        own = batch.column("own")
        if own.true_count:
            alone = batch.filter(own)
            none = pa.array([b""] * alone.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([alone.column("block"), alone.column("own"), none, alone.column("places")], names)
        rest = batch.filter(pa.compute.invert(own)).select(["block", "c", "cls", "places"])
        if rest.num_rows:
            held.append(rest)
            rows += rest.num_rows
        if rows >= GATHER_ROWS:
            yield from flush()
            rows = 0
    if held:
        yield from flush()


def _resolved(docs: DataFrame, units: Units, classes: np.ndarray, words: DataFrame, tokens: int) -> DataFrame:
    """(facts, seq): a row per block; its documents' numbers and the class of every token.

    ``tokens``, about the number of all, sets the number of tasks, so that none grows with the corpus.
    """
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tokens // TOKENS_PER_TASK)
    asked = _requests(docs, units, classes).repartition(tasks, "word")
    known = asked.join(words.select("word", "cls", "c").repartition(tasks, "word"), "word", "left")
    known = known.select("block", "own", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("cls", F.lit(-1)).alias("cls"), "places")
    lists = known.mapInArrow(_gathered, "block long, own boolean, counts binary, places binary")

    def run(table: pa.Table) -> pa.Table:
        own, heads, places = np.asarray(table["own"]), table["counts"].to_pylist(), table["places"].to_pylist()
        whole = places[int(np.flatnonzero(own)[0])]
        n = int(np.frombuffer(whole, np.int64, 1)[0])
        facts = np.frombuffer(whole, np.float64, _META * n, 8).reshape(_META, n).copy()
        seq = np.frombuffer(whole, "<u2", offset=8 + 8 * _META * n).copy()
        rest = np.flatnonzero(~own)
        if len(rest):
            at = np.frombuffer(b"".join([places[i] for i in rest]), "<u4")
            head = np.concatenate([np.frombuffer(heads[i], np.int64).reshape(3, -1) for i in rest], 1)
            count, cls = np.repeat(head[0], head[2]), np.repeat(head[1], head[2])
            seq[at[cls >= 0]] = cls[cls >= 0]
            # In the order of the text, so that sums do not depend on the rows' order.
            seen = np.zeros(len(seq), np.int64)
            seen[at] = count
            owner = np.repeat(np.arange(n), facts[3].astype(np.int64) + 1)
            facts[4] += np.bincount(owner, seen > 0, n)
            facts[5] += np.bincount(owner, np.log10(seen + 1.0), n)
        return pa.table({"facts": pa.array([facts.tobytes()], pa.binary()), "seq": pa.array([seq.tobytes()], pa.binary())})

    return lists.repartition(tasks, "block").groupBy("block").applyInArrow(run, "facts binary, seq binary")


def _opened(batch: pa.RecordBatch, end: int):
    """(facts, document of each token, class before, class) of each block."""
    for i in range(batch.num_rows):
        facts = np.frombuffer(batch.column("facts")[i].as_py(), np.float64).reshape(_META, -1)
        now = np.frombuffer(batch.column("seq")[i].as_py(), "<u2").astype(np.int64)
        # Texts end with their end token, so that each begins after one.
        yield facts, np.repeat(np.arange(facts.shape[1]), facts[3].astype(np.int64) + 1), np.concatenate(([end], now[:-1])), now


def _class_pairs(blocks: DataFrame, k: int) -> np.ndarray:
    """Class bigram counts of the training documents."""

    def run(batches):
        for batch in batches:
            for facts, owner, before, now in _opened(batch, k - 1):
                train = facts[2][owner] == 0
                n = np.bincount((before * k + now)[train], minlength=k * k)
                pair = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n[pair])], ["pair", "n"])

    moved = np.zeros(k * k)
    for r in blocks.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # classes squared
        moved[r["pair"]] = r["n"]
    return moved.reshape(k, k)


def scores(docs: DataFrame, held: Column) -> DataFrame:
    """A row per document: fold, token counts, the unigram base and the model's log10 probability."""
    model, _, blocks = _fitted(docs.select("doc_id", "text", held.alias("held")))
    all_log, end_log = float(np.log10(model.n + model.v + 1)), float(np.log10(model.n_docs + 1))
    n_train, end_known = model.n, model.n_docs > 0

    def run(batches):
        for batch in batches:
            for facts, owner, before, now in _opened(batch, len(model.moves) - 1):
                n = facts.shape[1]
                gained = np.bincount(owner, model.moves[before, now] - model.emits[now], n)
                tokens = facts[3].astype(np.int64) + 1
                columns = {
                    "doc_id": pa.array(facts[0].copy().view(np.int64), mask=facts[1] > 0), "held_out": pa.array(facts[2] > 0),
                    "n_tokens": pa.array(tokens), "n_known": pa.array(facts[4].astype(np.int64) + end_known),
                    "train_tokens": pa.array(np.full(n, n_train)), "base_score": pa.array(facts[5] + end_log - tokens * all_log),
                    "score": pa.array(facts[5] + gained),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.mapInArrow(run, schema)
