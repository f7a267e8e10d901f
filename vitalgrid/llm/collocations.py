"""Phrase collocations by direct-address tiling, recursively over frequent pairs.

Texts become blocks of one language and about ``BLOCK_BYTES``: a stream of word numbers, 0
where a piece ends, and the block's own table of words with their counts. The tables are summed, words with ``min_count``
occurrences or more are ranked by frequency (in steps of an eighth of a doubling), and the rank is a
word's id. Every block asks for the ids of its own words: they are dealt by hash to parts, a row for each block
and part, the ranked words are dealt alike, and what is known goes back by block as packed numbers.

Each further level counts pairs of neighbouring ids and makes the frequent ones its symbols:

1. in a block, pairs are counted by tiles of ``TILE`` x ``TILE`` ids: a tile with many pairs by one
   dense bincount, where frequent ids come together, all others as sorted coordinates;
2. a task merges its blocks' counts and sends them, dealt by hash and coded by their differences, to the
   tasks that add them up;
3. the frequent pairs are ranked again and get ids of their own.

At level k symbols are phrases of k words: a phrase's pair joins its first and its last
k - 1 words, which are both frequent if it is. Ids of up to ``KNOWN_SYMBOLS`` phrases a level are sent to
the tasks, which rebuild the level's stream from the words'; of more, blocks ask for theirs as for words.

A phrase carries the counts of all its heads and tails, so every cut's score is exact arithmetic on its own
row (decimals of 38 digits). A phrase inside a longer one of the same count has a neighbour
one word longer of that count, so each level is compared with the next one alone.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count
each; pieces end with a text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from vitalgrid.llm.common import LOWER, UPPER, numbered, stored, text_pieces
from vitalgrid.llm.textblock import mix

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
TILE = 1024
#: From this many pairs on a tile is counted densely; its table has TILE * TILE cells.
DENSE_PAIRS = TILE * TILE // 16
BLOCK_BYTES = 1 << 20
#: All open blocks of a task, whatever the number of languages.
OPEN_BYTES = 32 << 20
BLOCKS_PER_TASK = 16
MOST_IDS = 3_000_000_000
#: A level's phrases whose ids are broadcast: 16 bytes each, 32 MB at most.
KNOWN_SYMBOLS = 2_000_000
#: Pairs that a task merges before it sends them, and that one adding task is planned for.
MERGED_PAIRS, PAIRS_PER_PART = 4 << 20, 8 << 20
#: Questions for ids, and ranked symbols, that one answering task is planned for.
ASKED_PER_PART, RANKED_PER_PART = 4 << 20, 1 << 18

_BREAKS = re.compile(rb"[.,;:!?\x0A-\x0D]+")
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


class _Table(dict):
    """Numbers words from 1 in the order of their first use; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about a block, cut where pieces end."""
    first = 0
    while len(text) - first > BLOCK_BYTES:
        cut = _BREAKS.search(text, first + BLOCK_BYTES)
        if cut is None:
            break
        yield text[first : cut.end()]
        first = cut.end()
    yield text[first:]


def word_blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(block, lang, n, stream, symbols, counts): blocks of one language with their words, a block's frequent ones first."""

    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(name: str) -> pa.RecordBatch:
            nonlocal serial
            table = _Table({b".": 0})
            # Only an end of a piece can give the word '.'.
            words = _BREAKS.sub(b" . ", b".".join(held.pop(name)).translate(_FOLD)).split()
            sizes.pop(name)
            stream = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
            counts = np.bincount(stream, minlength=len(table))[1:]
            order = np.argsort(-counts, kind="stable")
            number = np.zeros(len(table), np.int64)
            number[order + 1] = np.arange(1, len(table))
            row = {
                "block": pa.array([part << 32 | serial]), "lang": pa.array([name]), "n": pa.array([int(counts.sum())]),
                "stream": pa.array([_packed(number[stream])], pa.binary()),
                "symbols": _list(pa.array(list(table)[1:], pa.binary()).cast(pa.string()).take(pa.array(order))),
                "counts": _list(pa.array(counts[order])),
            }
            serial += 1
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for batch in batches:
            names = batch.column("lang").to_pylist()
            for first, end, data, offsets in text_pieces(batch, "text"):
                whole = data.tobytes()
                for name, a, b in zip(names[first:end], offsets.tolist(), offsets[1:].tolist()):
                    for piece in _parts(whole[a:b]):
                        held.setdefault(name, []).append(piece)
                        sizes[name] = sizes.get(name, 0) + len(piece) + 1
                        if sizes[name] >= BLOCK_BYTES:
                            yield flush(name)
                    if sum(sizes.values()) >= OPEN_BYTES:
                        yield flush(max(sizes, key=sizes.get))
        for name in list(held):
            yield flush(name)

    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, "block long, lang string, n long, stream binary, symbols array<string>, counts array<long>")


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def count_tiles(x: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the pairs (x, y); a code is x * width + y.

    Dense tiles come first, each in the order of its cells, then all other pairs in the order of their codes.
    """
    codes, counts = [], []
    across = width // TILE + 1
    tiles, inverse, sizes = np.unique(x // TILE * across + y // TILE, return_inverse=True, return_counts=True)
    for t in np.flatnonzero(sizes >= DENSE_PAIRS):
        at = np.flatnonzero(inverse == t)
        dense = np.bincount(x[at] % TILE * TILE + y[at] % TILE)
        used = np.flatnonzero(dense)
        row, column = divmod(int(tiles[t]), across)
        codes.append((row * TILE + used // TILE) * width + column * TILE + used % TILE)
        counts.append(dense[used])
    at = np.flatnonzero(sizes[inverse] < DENSE_PAIRS)
    code, count = np.unique(x[at] * width + y[at], return_counts=True)
    return np.concatenate([*codes, code]), np.concatenate([*counts, count])


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes with their summed counts."""
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(count, first) if len(code) else count


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on, seven bits a byte, the lowest first; the last byte of each is below 128."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        size += values >= 1 << bits
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = ends - size
    for i in range(9):
        live = np.flatnonzero(size > i)
        if not len(live):
            break
        more = (size[live] > i + 1).astype(np.uint8) << 7
        out[at[live] + i] = (values[live] >> (7 * i) & 127).astype(np.uint8) | more
    return out.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts) if len(ends) else np.zeros(0, np.int64)


@dataclass
class Symbols:
    """One level's phrases: sorted codes, their ids, and the number of ids below."""

    codes: np.ndarray
    ids: np.ndarray
    width: int


@dataclass
class Reader:
    """Opens rows of ids, -1 for none, and puts the known symbols of further levels on top."""

    kind: str
    levels: list[Broadcast]

    def streams(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """(block, ids of the highest level), one by one."""
        for i in range(batch.num_rows):
            seq = np.frombuffer(batch.column("ids")[i].as_py(), self.kind).astype(np.int64)
            for level in self.levels:
                s = level.value
                at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
                code = seq[at] * s.width + seq[at + 1]
                where = np.minimum(np.searchsorted(s.codes, code), len(s.codes) - 1)
                hit = s.codes[where] == code
                seq = np.full(len(seq), -1, np.int64)
                seq[at[hit]] = s.ids[where[hit]]
            yield batch.column("block")[i].as_py(), seq


@dataclass
class Blocks:
    """(block, ids), a row per block, and how to read them."""

    rows: DataFrame
    reader: Reader


def _kind(width: int) -> str:
    return "<i4" if width < 1 << 31 else "<i8"


def _dealt(symbols: pa.Array, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places) of symbols by hash."""
    if pa.types.is_integer(symbols.type):
        hashes = mix(np.asarray(symbols).astype(np.int64).view(np.uint64))
    else:
        hashes = np.fromiter((zlib.crc32(w.encode()) for w in symbols.to_pylist()), np.uint64, len(symbols))
    part = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield i, order[cuts[i] : cuts[i + 1]]


def _written(symbols: pa.Array) -> bytes:
    """Symbols as bytes: words with a blank between each, which no word holds, or packed numbers."""
    if pa.types.is_integer(symbols.type):
        return _packed(np.asarray(symbols).astype(np.int64))
    return " ".join(symbols.to_pylist()).encode()


def _read(data: bytes, numbers: bool) -> list:
    return _unpacked(data).tolist() if numbers else data.split(b" ")


def answers(blocks: DataFrame, ranked: DataFrame, on: list[str], parts: int) -> DataFrame:
    """(block, at, ids): the places and ids of the ranked ones among a block's symbols, packed; a row for each part that has some."""
    numbers = isinstance(ranked.schema["symbol"].dataType, T.LongType)
    lang = F.col("lang") if "lang" in on else F.lit("")

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                symbols = batch.column("symbols")[i].values
                rows = [(p, _packed(np.diff(at, prepend=0)), _written(symbols.take(pa.array(at)))) for p, at in _dealt(symbols, parts)]
                if rows:
                    yield _rows(rows, batch.column("block")[i].as_py(), batch.column("lang")[i].as_py())

    def tell(batches):
        for batch in batches:
            names = batch.column("lang")
            for name in names.unique():
                own = batch.filter(pc.equal(names, name))
                ids = np.asarray(own.column("id")).astype(np.int64)
                symbols = own.column("symbol")
                yield _rows([(p, _packed(ids[at]), _written(symbols.take(pa.array(at)))) for p, at in _dealt(symbols, parts)], -1, name.as_py())

    def answer(batches):
        now, known = -1, defaultdict(dict)  # of one part; its ranked symbols, block -1, come first
        for batch in batches:
            rows = []
            for part, block, name, at, symbols in zip(*[batch.column(c).to_pylist() for c in ("part", "block", "lang", "at", "symbols")]):
                if part != now:
                    now, known = part, defaultdict(dict)
                if block < 0:
                    known[name].update(zip(_read(symbols, numbers), _unpacked(at).tolist()))
                    continue
                own = known[name]
                ids = np.array([own.get(s, -1) for s in _read(symbols, numbers)], np.int64)
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    rows.append((block, _packed(np.diff(np.cumsum(_unpacked(at))[hit], prepend=0)), _packed(ids[hit])))
            if rows:
                kinds = (pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "at", "ids"])

    schema = "part int, block long, lang string, at binary, symbols binary"
    asked = blocks.select("block", lang.alias("lang"), "symbols").mapInArrow(ask, schema)
    told = ranked.select(lang.alias("lang"), "symbol", "id").mapInArrow(tell, schema)
    rows = asked.union(told).repartition(parts, "part").sortWithinPartitions("part", "block")
    return rows.mapInArrow(answer, "block long, at binary, ids binary")


def _rows(rows: list[tuple[int, bytes, bytes]], block: int, lang: str) -> pa.RecordBatch:
    part, at, symbols = zip(*rows)
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([block] * n, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(at, pa.binary()), pa.array(symbols, pa.binary())],
        ["part", "block", "lang", "at", "symbols"],
    )


def with_ids(blocks: DataFrame, ranked: DataFrame, on: list[str], width: int) -> Blocks:
    """Streams of ids for ``blocks`` (block, stream, symbols): each asks for the ids of its own symbols."""
    spark, kind = blocks.sparkSession, _kind(width)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, asked = blocks.agg(F.count(F.lit(1)), F.sum(F.size("symbols"))).first()
    tasks = max(shuffles, -(-n // BLOCKS_PER_TASK))
    parts = max(shuffles, -(-(asked or 0) // ASKED_PER_PART), -(-width // RANKED_PER_PART))
    hits = answers(blocks, ranked, on, parts).repartition(tasks, "block")
    hits = hits.groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("hits"))  # a block's symbols at most

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                stream = _unpacked(batch.column("stream")[i].as_py())
                ids = np.full(int(stream.max(initial=0)) + 1, -1, np.int64)
                for hit in batch.column("hits")[i].as_py():
                    ids[np.cumsum(_unpacked(hit["at"])) + 1] = _unpacked(hit["ids"])
                row = [batch.column("block").slice(i, 1), pa.array([ids[stream].astype(kind).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["block", "ids"])

    rows = blocks.select("block", "stream").repartition(tasks, "block").join(hits.hint("merge"), "block")
    return Blocks(stored(rows.mapInArrow(run, "block long, ids binary")), Reader(kind, []))


def pair_counts(blocks: Blocks, width: int, parts: int, min_count: int) -> DataFrame:
    """(symbol, f): the frequent pairs of neighbouring ids; ``width``: the number of ids."""
    reader = blocks.reader

    def count(batches):
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def flush():
            code, count = _merged(codes, counts)
            part = (mix(code.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            code, count = code[order], count[order]
            at = np.flatnonzero(np.diff(cuts))
            rows = [(_packed(np.diff(code[a:b], prepend=0)), _packed(count[a:b])) for a, b in zip(cuts[at], cuts[at + 1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)]], ["part", "codes", "counts"]
            )
            codes.clear()
            counts.clear()

        for batch in batches:
            for _, seq in reader.streams(batch):
                at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
                if len(at):
                    code, n = count_tiles(seq[at], seq[at + 1], width)
                    codes.append(code)
                    counts.append(n)
                    size += len(code)
                if size >= MERGED_PAIRS:
                    yield from flush()
                    size = 0
        if codes:
            yield from flush()

    def add(batches):
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for a, b in zip(batch.column("codes"), batch.column("counts")):
                codes.append(np.cumsum(_unpacked(a.as_py())))
                counts.append(_unpacked(b.as_py()))
                size += len(codes[-1])
                if size > 2 * len(codes[0]) + MERGED_PAIRS:
                    code, n = _merged(codes, counts)
                    codes, counts, size = [code], [n], len(code)
        if codes:
            code, n = _merged(codes, counts)
            many = n >= min_count
            yield pa.RecordBatch.from_arrays([pa.array(code[many]), pa.array(n[many])], ["symbol", "f"])

    sums = blocks.rows.mapInArrow(count, "part int, codes binary, counts binary")
    return sums.repartition(parts, "part").select("codes", "counts").mapInArrow(add, "symbol long, f long")


def pair_tables(blocks: Blocks, width: int) -> DataFrame:
    """(block, stream, symbols): every block's pairs as its own table, and their places."""
    reader = blocks.reader

    def run(batches):
        for batch in batches:
            for block, seq in reader.streams(batch):
                at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
                codes, place = np.unique(seq[at] * width + seq[at + 1], return_inverse=True)
                stream = np.zeros(len(seq), np.int64)
                stream[at] = place + 1
                row = [pa.array([block]), pa.array([_packed(stream)], pa.binary()), _list(pa.array(codes))]
                yield pa.RecordBatch.from_arrays(row, ["block", "stream", "symbols"])

    return blocks.rows.mapInArrow(run, "block long, stream binary, symbols array<long>")


def ranked_symbols(counts: DataFrame, on: list[str]) -> DataFrame:
    """(symbol, f, id): symbols numbered from 0 by falling frequency."""
    # Pieces of the ranking: an eighth of a doubling of the frequency, in 64 parts.
    step = 1024 - F.floor(F.log2("f") * 8)
    frequent = stored(counts.withColumn("chunk", step * 64 + F.pmod(F.xxhash64("symbol"), F.lit(64))))
    return stored(numbered(frequent, [], [F.desc("f"), *on], "id", "chunk").drop("chunk"))


def _known(ranked: DataFrame, width: int) -> Symbols:
    """A level's codes and ids on the driver: at most ``KNOWN_SYMBOLS`` rows."""
    table = ranked.select("symbol", "id").toArrow()
    codes, ids = np.asarray(table["symbol"]).astype(np.int64), np.asarray(table["id"]).astype(np.int64)
    order = np.argsort(codes)
    return Symbols(codes[order], ids[order], width)


def _phrases(ranked: DataFrame, shorter: DataFrame, width: int) -> DataFrame:
    """Phrases of one word more: their parts' ids, words, and the counts of all heads and tails."""
    pairs = ranked.select("id", "f", F.expr(f"symbol div {width}").alias("x"), (F.col("symbol") % width).alias("y"))
    first = shorter.select(F.col("id").alias("x"), "lang", "words", F.concat("heads", F.array("f")).alias("heads"), F.col("f").alias("fx"))
    last = shorter.select(
        F.col("id").alias("y"), F.element_at("words", -1).alias("word"), F.concat(F.array("f"), "tails").alias("tails"), F.col("f").alias("fy")
    )
    whole = pairs.join(first, "x").join(last, "y")
    return whole.select("id", "lang", "f", F.concat("words", F.array("word")).alias("words"), "heads", "tails", "x", "y", "fx", "fy")


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n), [phrases of 1 word, of 2 words, ...]); phrases: id, lang, f, words, heads, tails, and the parts of longer ones."""
    spark = docs.sparkSession
    words = stored(word_blocks(docs, text, lang))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (words.agg(F.sum("n")).first()[0] or 0) // PAIRS_PER_PART)
    seen = words.select("lang", F.explode(F.arrays_zip("symbols", "counts")).alias("s"))
    seen = seen.groupBy("lang", F.col("s.symbols").alias("symbol")).agg(F.sum("s.counts").alias("f"))
    ranked = ranked_symbols(seen.where(F.col("f") >= min_count), ["lang", "symbol"])
    none = F.array().cast("array<bigint>")
    levels = [ranked.select("id", "lang", "f", F.array("symbol").alias("words"), none.alias("heads"), none.alias("tails"))]
    width = ranked.count()
    blocks = with_ids(words, ranked, ["lang", "symbol"], width) if width else None
    for level in range(2, longest + 1):
        if not width:
            break
        if width > MOST_IDS:
            raise ValueError(f"{width} phrases of a level: a pair of them does not fit 63 bits")
        ranked = ranked_symbols(pair_counts(blocks, width, parts, min_count), ["symbol"])
        levels.append(stored(_phrases(ranked, levels[-1], width)))
        below, width = width, ranked.count()
        if level < longest and 0 < width <= KNOWN_SYMBOLS:
            known = spark.sparkContext.broadcast(_known(ranked, below))
            blocks = Blocks(blocks.rows, Reader(blocks.reader.kind, [*blocks.reader.levels, known]))
        elif level < longest and width:
            blocks = with_ids(stored(pair_tables(blocks, below)), ranked, ["symbol"], width)
    return totals, levels


def scored(rows: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score by the lowest cut, the first one among equals; products are decimals."""
    whole = "decimal(19,0)"
    cut = F.expr(
        f"transform(sequence(1, size(heads)), k -> named_struct("
        f"'score', cast(1000 * f as {whole}) * cast(n as {whole}) div (cast(heads[k - 1] as {whole}) * cast(tails[k - 1] as {whole})),"
        f"'k', k, 'l', heads[k - 1], 'r', tails[k - 1]))"
    )
    return rows.withColumn("low", F.array_min(cut)).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n",
        F.col("low.score").alias("score"),
    )


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    The score of a cut is floor(1000 * a * n / (l * r)), a phrase's is that of its lowest cut. A phrase
    goes where a longer one that holds it has the same count.
    """
    totals, levels = phrases(docs, min_count, longest, text, lang)
    found = []
    for i, level in enumerate(levels[1:], 1):
        if i + 1 < len(levels):
            longer = levels[i + 1]
            inside = longer.where("f = fx").select(F.col("x").alias("id")).union(longer.where("f = fy").select(F.col("y").alias("id")))
            level = level.join(inside.distinct(), "id", "left_anti")
        found.append(level.select("lang", "words", "f", "heads", "tails"))
    if not found:
        spark = docs.sparkSession
        long = T.LongType()
        return spark.createDataFrame([], T.StructType([
            T.StructField("lang", T.StringType()), T.StructField("rank", long), T.StructField("phrase", T.StringType()),
            *[T.StructField(c, long) for c in ("a", "l", "r", "n", "score")],
        ]))
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    rows = scored(rows.join(totals, "lang"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Two rounds, so that the last one meets at most 64 * top rows of a language.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))
    rows = rows.withColumn("rank", first).where(F.col("rank") <= top).drop("part")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
