"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

The field has two labels, line features and a transition score. It is fitted on the lines of a
bounded sample of labelled documents (``SAMPLE_DOCS`` documents by hash order, of each at most
``SAMPLE_LINES`` lines in runs of ``RUN_LINES`` neighbours spread over it), a document's label standing for all
its lines. A run is a chain of its own, so that only lines that do follow one another teach the transitions. Viterbi decoding then labels every line of every whole document; the
share of words in content lines decides. Two plain rules come first: too few words,
or too many words in repeated windows.

Defined cases: a null or empty text has no words and fails; without labels of both
kinds every line counts as content; lines without a word keep the label the chain
gives them but weigh nothing; rows are judged one by one, so equal rows agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vitalgrid.llm.common import text_pieces
from vitalgrid.llm.textblock import TextBlock, mix

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SAMPLE_DOCS = 1500
SAMPLE_LINES = 256
RUN_LINES = 32
CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
PIECE_BYTES = 1 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_CLASSES = [  # byte classes whose share of a line's characters is a feature
    np.isin(np.arange(256), np.arange(65, 91)), np.isin(np.arange(256), np.arange(48, 58)),
    np.isin(np.arange(256), [ord(c) for c in "!?"]), np.isin(np.arange(256), [ord(c) for c in ".,;:"]),
    np.isin(np.arange(256), [ord(c) for c in "@/=_\"'()[]{}\\~^+"]),
]
N_FEATURES = 14


@dataclass
class Measures:
    """Per text: counts; per line: features, words and the lines' bounds."""

    counts: dict[str, np.ndarray]
    features: np.ndarray
    words: np.ndarray
    line_at: np.ndarray


def _per(at: np.ndarray, running: np.ndarray) -> np.ndarray:
    return running[at[1:]] - running[at[:-1]]


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(x, dtype=np.int64)))


def measure(block: TextBlock, lines: bool = True) -> Measures:
    data, offsets, n = block.data, block.offsets, block.n
    lead = (data & 0xC0) != 0x80  # a character's first byte
    chars = _running(lead & ~block.space)
    symbols = _running(_SYMBOL[data])
    # Lines: one more than line breaks in each text.
    breaks = np.flatnonzero(data == 10)
    doc_of_break = np.searchsorted(offsets, breaks, "right") - 1
    per_doc = np.bincount(doc_of_break, minlength=n)[:n] + 1
    line_at = _running(per_doc)
    starts = np.empty(line_at[-1], np.int64)
    ends = np.empty(line_at[-1], np.int64)
    is_first = np.zeros(line_at[-1], bool)
    is_first[line_at[:-1]] = True
    starts[line_at[:-1]], starts[~is_first] = offsets[:-1], breaks + 1
    is_last = np.zeros(line_at[-1], bool)
    is_last[line_at[1:] - 1] = True
    ends[is_last], ends[~is_last] = offsets[1:], breaks
    doc_of_line = np.repeat(np.arange(n), per_doc)
    word_at = np.searchsorted(block.starts, np.append(starts, len(data)))
    word_at[:-1] = np.searchsorted(block.starts, starts)
    words = np.searchsorted(block.starts, ends) - word_at[:-1]
    # Lines with a word that repeat an earlier line of their text.
    full = np.flatnonzero(words)
    key = mix(block.hashes(starts[full], ends[full]) + mix(doc_of_line[full].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(starts), bool)
    again[full[order[1:][key[order][1:] == key[order][:-1]]]] = True
    # Words inside windows that occur twice or more in their text.
    hashes = block.word_hashes()
    echo = np.zeros(len(hashes), bool)  # a word like the one in front of it
    echo[1:] = (hashes[1:] == hashes[:-1]) & (block.doc_of_word[1:] == block.doc_of_word[:-1])
    echoes = _running(echo)
    first, gram = block.windows(hashes, WINDOW)
    gram = mix(gram + mix(block.doc_of_word[first].astype(np.uint64)))
    order = np.argsort(gram)
    same = gram[order][1:] == gram[order][:-1]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(block.starts) + 1, np.int64)
    np.add.at(edges, first[twice], 1)
    np.add.at(edges, first[twice] + WINDOW, -1)
    repeated = _running(np.cumsum(edges[:-1]) > 0)
    counts = {
        "n_words": np.diff(block.word_at), "word_chars": _per(offsets, chars), "n_symbols": _per(offsets, symbols),
        "n_dup_lines": np.bincount(doc_of_line, again, n).astype(np.int64)[:n], "n_repeat_words": _per(block.word_at, repeated),
    }
    if not lines:
        return Measures(counts, np.zeros((0, N_FEATURES)), words, line_at)
    solid = np.maximum(1, chars[ends] - chars[starts])
    w = np.maximum(1, words)
    features = [
        np.ones(len(starts)), np.log1p(words), words == 0, np.minimum(solid / w, 30.0), (symbols[ends] - symbols[starts]) / solid,
        *[(r[ends] - r[starts]) / solid for r in map(_running, (c[data] for c in _CLASSES))],
        again, (echoes[word_at[:-1] + words] - echoes[word_at[:-1]]) / w, (repeated[word_at[:-1] + words] - repeated[word_at[:-1]]) / w,
        np.log1p(counts["n_repeat_words"] / np.maximum(1, counts["n_words"]))[doc_of_line],
    ]
    return Measures(counts, np.stack(features, 1).astype(np.float64), words, line_at)


@dataclass
class Field:
    """A two-label chain: label 1 is content."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # from x to

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights

    def viterbi(self, features: np.ndarray, line_at: np.ndarray) -> np.ndarray:
        """The best labels; all texts advance together, line by line."""
        scores = self.scores(features)
        lengths = np.diff(line_at)
        order = np.argsort(-lengths, kind="stable")
        best = np.zeros((len(lengths), 2))
        back = np.zeros((len(features), 2), np.int8)
        falling = -lengths[order]
        top = int(lengths.max(initial=0))
        for t in range(top):
            live = order[: np.searchsorted(falling, -t, "left")]  # texts with more than t lines
            at = line_at[live] + t
            if t == 0:
                best[live] = scores[at]
                continue
            into = best[live][:, :, None] + self.moves[None]
            back[at] = into.argmax(1)
            best[live] = into.max(1) + scores[at]
        label = best.argmax(1).astype(np.int8)
        out = np.zeros(len(features), np.int8)
        for t in range(top - 1, -1, -1):
            live = order[: np.searchsorted(falling, -t, "left")]
            at = line_at[live] + t
            out[at] = label[live]
            if t:
                label[live] = back[at, label[live]]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Fit:
    """The penalised log-likelihood of labelled chains and its gradient.

    A chain's label stands for all its lines. Both labels count alike, and so does each document: ``doc`` tells
    which chains are of one.
    """

    def __init__(self, features: np.ndarray, line_at: np.ndarray, label: np.ndarray, doc: np.ndarray | None = None, l2: float = 1e-3):
        self.mean, self.scale = features.mean(0), features.std(0)
        self.mean[0], self.scale[0] = 0.0, 1.0
        self.scale[self.scale < 1e-9] = 1.0
        self.x, self.line_at, self.l2 = (features - self.mean) / self.scale, line_at, l2
        lengths = np.diff(line_at)
        order = np.argsort(-lengths, kind="stable")
        falling = -lengths[order]
        self.lives = [order[: np.searchsorted(falling, -t, "left")] for t in range(int(lengths.max()))]
        self.y = np.repeat(label, lengths)
        self.gold = np.zeros((len(self.x), 2))
        self.gold[np.arange(len(self.x)), self.y] = 1
        _, first, doc = np.unique(np.arange(len(label)) if doc is None else doc, return_index=True, return_inverse=True)
        share = np.bincount(label[first], minlength=2) / len(first)
        weight = (0.5 / np.maximum(share, 1e-9))[label] / np.bincount(doc, lengths)[doc]
        self.per_line = np.repeat(weight, lengths)
        self.gold_moves = np.zeros((2, 2))
        for c in (0, 1):
            self.gold_moves[c, c] = (weight * (lengths - 1))[label == c].sum()
        self.total = self.per_line.sum()

    def field(self, theta: np.ndarray) -> Field:
        return Field(self.mean, self.scale, theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))

    def value_and_gradient(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        weights, moves = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        s, line_at = self.x @ weights, self.line_at
        ahead, behind = np.zeros_like(s), np.zeros_like(s)
        for t, live in enumerate(self.lives):
            at = line_at[live] + t
            ahead[at] = s[at] if t == 0 else s[at] + _log_sum(ahead[at - 1][:, :, None] + moves[None], 1)
        for t in range(len(self.lives) - 2, -1, -1):
            at = line_at[self.lives[t + 1]] + t
            behind[at] = _log_sum(moves[None] + (s[at + 1] + behind[at + 1])[:, None, :], 2)
        z = _log_sum(ahead + behind, 1)
        p = np.exp(ahead + behind - z[:, None])
        follows = np.ones(len(self.x), bool)
        follows[line_at[:-1]] = False
        at = np.flatnonzero(follows)
        pair = np.exp(ahead[at - 1][:, :, None] + moves[None] + (s[at] + behind[at])[:, None, :] - z[at][:, None, None])
        g_moves = self.gold_moves - (pair * self.per_line[at][:, None, None]).sum(0)
        g = np.concatenate([(self.x.T @ ((self.gold - p) * self.per_line[:, None])).ravel(), g_moves.ravel()]) / self.total
        given = self.per_line @ s[np.arange(len(s)), self.y] + (self.gold_moves * moves).sum()
        # A chain's weight is that of its first line.
        value = (given - self.per_line[line_at[:-1]] @ z[line_at[:-1]]) / self.total
        return float(value - self.l2 / 2 * theta @ theta), g - self.l2 * theta


def fit_field(features: np.ndarray, line_at: np.ndarray, label: np.ndarray, doc: np.ndarray | None = None, rounds: int = 150) -> Field:
    """Maximum likelihood with an L2 penalty over chains of at least one line."""
    task = Fit(features, line_at, label, doc)
    theta, m, v = np.zeros(2 * features.shape[1] + 4), 0.0, 0.0
    for step in range(1, rounds + 1):
        _, g = task.value_and_gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return task.field(theta)


def sample_runs(first: int, end: int, lines: int = SAMPLE_LINES, run: int = RUN_LINES) -> list[tuple[int, int]]:
    """At most ``lines`` of the lines from ``first`` to ``end``, as runs of neighbours spread evenly."""
    if end - first <= lines:
        return [(first, end)]
    starts = np.linspace(first, end - run, max(1, lines // run)).astype(np.int64)
    return [(int(a), int(a) + run) for a in starts]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Field | None:
    """Fit on a sample of labelled documents; None without both labels."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def lines(batches):
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                m = measure(TextBlock(data, offsets))
                rows = [sample_runs(int(a), int(b), sample_lines) for a, b in zip(m.line_at, m.line_at[1:])]
                runs = [[m.features[a:b].tobytes() for a, b in r] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, end - first) for c in ("doc_id", "_quality")] + [pa.array(runs, pa.list_(pa.binary()))],
                    ["doc_id", "_quality", "runs"],
                )

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "_quality", "text")
    found = sample.mapInArrow(lines, "doc_id long, _quality int, runs array<binary>").collect()  # the bounded sample
    found.sort(key=lambda r: (r["doc_id"], [bytes(x) for x in r["runs"]]))
    label = np.array([r["_quality"] for r in found for _ in r["runs"]], np.int64)
    if len(np.unique(label)) < 2:
        return None
    doc = np.repeat(np.arange(len(found)), [len(r["runs"]) for r in found])
    parts = [np.frombuffer(x, np.float64).reshape(-1, N_FEATURES) for r in found for x in r["runs"]]
    return fit_field(np.concatenate(parts), _running([len(p) for p in parts]), label, doc)


def judge(docs: DataFrame, field: Field | None, share: float = CONTENT_SHARE) -> DataFrame:
    """``docs`` with the counts, base_failed, content_words and kept."""
    added = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long")]
    added += [("content_words", "long"), ("base_failed", "boolean"), ("kept", "boolean")]
    clash = {c.lower() for c in docs.columns} & {c for c, _ in added}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in clash])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.BooleanType() if t == "boolean" else T.LongType()) for c, t in added]])

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_pieces(batch, "text", PIECE_BYTES):
                m = measure(TextBlock(data, offsets), lines=field is not None)
                n = m.counts["n_words"]
                content = n
                if field is not None:
                    label = field.viterbi(m.features, m.line_at)
                    content = _per(m.line_at, _running(m.words * label))
                failed = (n < MIN_WORDS) | (100 * m.counts["n_repeat_words"] > REPEAT_PERCENT * n)
                kept = ~failed & (content >= share * n)
                columns = [*m.counts.values(), content, failed, kept]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, columns)], [*part.schema.names, *[c for c, _ in added]])

    return docs.mapInArrow(run, schema)
