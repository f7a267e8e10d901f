"""Periodic runs of words: seeds on diagonals, each extended once.

A run is a stretch of words with smallest period q and a length of at least
max(``MIN_LENGTH``, 2q) that no neighbouring word extends. Two copies of a run that
lie q words apart share at least max(MIN_LENGTH - q, q) words, so an index of
k-grams of that guaranteed overlap finds every run by two occurrences of one gram:

* periods below ``MIN_LENGTH``: grams of 6 words at every position; occurrences less
  than MIN_LENGTH apart are paired;
* periods from 2k to 4k - 1 with k = 6, 12, 24, ...: grams of k words at every
  k-th position, one of which lies in any overlap of 2k words, paired with the occurrences
  2k to 4k - 1 words behind. A level has at most two pairs a word.

Grams are named exactly, a long one by the names of its halves; names that occur once
are struck out, so ordinary text leaves the index after a level or two. Per lag, the
seeds that continue one another are covered by one stretch, and only its two ends are
extended, by halving steps over the names of shorter grams.

Defined cases: a null or empty text has no words and no runs, its collapsed text is
empty; rows are judged one by one, so repeated rows agree; columns of ``docs`` that carry an
output's name are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from vitalgrid.llm.common import BLANKS, text_pieces

MIN_LENGTH = 12
#: Twice MIN_LENGTH - q and q meet at q = 6: any overlap has six words or more.
GRAM = MIN_LENGTH // 2
SEGMENT = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Ids(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _segments(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``SEGMENT`` bytes at a time."""
    blank = set(BLANKS.encode())
    first = 0
    while first < len(text):
        end = min(len(text), first + SEGMENT)
        while end < len(text) and text[end] not in blank:
            end += 1
        yield text[first:end].split()  # bytes split at [\x20\x09-\x0D]
        first = end


def _name(key: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Names of the grams at positions ``at``; -1 elsewhere and for those that occur once."""
    out = np.full(size, -1, np.int64)
    if len(at):
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count > 1
        name = np.where(again[name], (np.cumsum(again) - 1)[name], -1)
        out[at] = name
    return out


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Names of the grams made of ``left`` at a position and ``right`` ``shift`` words behind."""
    if len(left) <= shift:
        return np.full(len(left), -1, np.int64)
    at = np.flatnonzero((left[: len(left) - shift] >= 0) & (right[shift:] >= 0))
    return _name(left[at] * (int(right.max(initial=0)) + 1) + right[at + shift], at, len(left))


def _near_seeds(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) of equal grams less than ``MIN_LENGTH`` apart."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    lags, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, MIN_LENGTH):
        lag = at[step:] - at[:-step]
        hit = np.flatnonzero((names[at[step:]] == names[at[:-step]]) & (lag < MIN_LENGTH))
        if not len(hit):
            break
        lags.append(lag[hit])
        places.append(at[:-step][hit])
    return np.concatenate(lags), np.concatenate(places)


def _far_seeds(names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) of the grams at every k-th position and their equals 2k to 4k - 1 words behind."""
    size = len(names)
    at = np.flatnonzero(names >= 0)
    index = np.sort(names[at] * size + at)
    anchor = at[at % k == 0]
    base = names[anchor] * size
    low = np.searchsorted(index, base + np.minimum(anchor + 2 * k, size))
    count = np.searchsorted(index, base + np.minimum(anchor + 4 * k, size)) - low
    place = np.repeat(anchor, count)
    rank = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    return index[np.repeat(low, count) + rank] % size - place, place


def _covered(lag: np.ndarray, place: np.ndarray, k: int, stride: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lag, start, end) of the stretches that seeds continuing one another cover."""
    key = np.sort(lag * (size + k + 1) + place)
    if not len(key):
        return key, key, key
    opens = np.flatnonzero(np.diff(key, prepend=key[0] - stride - 1) != stride)
    closes = np.append(opens[1:], len(key)) - 1
    lag = key[opens] // (size + k + 1)
    return lag, key[opens] % (size + k + 1), key[closes] % (size + k + 1) + k


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period.

    ``words``: word numbers of one text after the other. Texts share no number, hence no
    gram and no run crosses a border.
    """
    size = len(words)
    words = words.astype(np.int64)
    one = _name(words, np.arange(size), size)
    two = _joined(one, one, 1)
    three = _joined(two, two, 1)
    names = _joined(three, three, 3)
    shorter = [(3, three), (1, one), (1, one)]  # longest first
    lag, start, end = _covered(*_near_seeds(names), GRAM, 1, size)
    found = [(lag, start, end)]
    k = GRAM
    while (names >= 0).any():
        lag, start, end = _covered(*_far_seeds(names, k), k, k, size)
        for step, name in shorter:
            at = np.flatnonzero(start >= step)
            left = name[start[at] - step]
            at = at[(left >= 0) & (left == name[start[at] - step + lag[at]])]
            start[at] -= step
            at = np.flatnonzero(end + lag < size)
            right = name[end[at]]
            at = at[(right >= 0) & (right == name[end[at] + lag[at]])]
            end[at] += step
        found.append((lag, start, end))
        shorter.insert(0, (k, names))
        names, k = _joined(names, names, k), 2 * k
    lag, start, end = (np.concatenate(x) for x in zip(*found))
    length = end - start + lag
    at = np.flatnonzero(length >= np.maximum(MIN_LENGTH, 2 * lag))
    at = at[np.lexsort((lag[at], length[at], start[at]))]
    # A multiple of a run's period gives the same stretch: the smallest one counts.
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(start[at]) != 0) | (np.diff(length[at]) != 0)
    at = at[first]
    at = at[np.lexsort((lag[at], start[at]))]
    return start[at], length[at], lag[at]


def _collapse(data: bytes, offsets: list[int]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text."""
    ids, tables, bounds = [], [], [0]
    base = 0
    for a, b in zip(offsets, offsets[1:]):
        table, n = _Ids(), 0
        for words in _segments(data[a:b]):
            ids.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)) + base)
            n += len(words)
        base += len(table)
        tables.append(table)
        bounds.append(bounds[-1] + n)
    words = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    start, length, period = find_runs(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    bounds = np.array(bounds)
    at = np.searchsorted(start, bounds)
    texts, base = [], 0
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        if at[i] == at[i + 1]:
            parts = (b" ".join(w) for w in _segments(data[a:b]))
            texts.append(b" ".join(p for p in parts if p))
        else:
            own = words[bounds[i] : bounds[i + 1]][kept[bounds[i] : bounds[i + 1]]] - base
            texts.append(b" ".join(map(list(tables[i]).__getitem__, own.tolist())))
        base += len(tables[i])
    home = np.repeat(bounds[:-1], np.diff(at))
    rows = pa.StructArray.from_arrays([pa.array(start - home), pa.array(length), pa.array(period)], fields=list(RUN))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows), pa.array(texts, pa.binary()).cast(pa.string())


def collapse_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the periodic runs of each whole text and the text without their repetitions.

    ``runs``: (start, length, period) of every run in words, by start and period.
    ``collapsed``: the words outside all runs and each run's first ``period`` words, joined by single spaces.
    """
    added = {runs.lower(), collapsed.lower()}
    keep = [f for f in docs.schema.fields if f.name.lower() not in added or f.name == text]
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([*keep, T.StructField(runs, T.ArrayType(run)), T.StructField(collapsed, T.StringType())])

    def work(batches):
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch, text):
                part = batch.slice(first, end - first)
                found = _collapse(data.tobytes(), offsets.tolist())
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, runs, collapsed])

    return docs.select(*[f.name for f in keep]).mapInArrow(work, schema)
