"""Main text of web pages by a tree-structured graphical model over their blocks.

Every node of a page's block tree (``dom.py``) is content or not. A node has a score from its
features; an edge has a score from its kind and the labels of parent and child. Sum-product
messages pass upward and then downward, level by level for many pages at once, and give each
node's exact marginal. Runs of text with a marginal of one half or more are the page's main text.

The model is fitted by maximum likelihood, with the same messages for the
expected counts, on labelled pages of two kinds, each page counting alike:

* pages of the table that mark their article by an ``article`` or ``main`` element, in which
  navigation, asides, footers and forms are not content: ``SAMPLE_PAGES`` of at most ``SAMPLE_CHARS`` characters, by hash order;
* ``RULE_PAGES`` pages made by rule (``page_rules.py``) with the layouts, comments, notices and forms that the table
  may lack.

Defined cases: a null or empty page, or one without text, has an empty text; a page without content
blocks as well; rows are judged one by one, so repeated rows agree; the page column is not returned,
columns that carry an output's name are replaced, all others pass through. White space is
Unicode white space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vitalgrid.llm.dom import HEADINGS, Tree, read_page
from vitalgrid.llm.page_rules import labelled_pages

SAMPLE_PAGES = 200
SAMPLE_CHARS = 30_000
RULE_PAGES = 200
ROUNDS = 100
L2 = 1e-4
PIECE_CHARS = 2 << 20

GROUPS = [
    {"article", "main"}, {"nav", "menu"}, {"header", "hgroup"}, {"footer", "address"}, {"aside"}, {"form", "fieldset", "legend", "search", "dialog"},
    {"section"}, {"div", "center"}, {"p"}, set(HEADINGS), {"ul", "ol", "dl"}, {"li", "dt", "dd"},
    {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"blockquote", "pre", "figure", "figcaption", "details", "summary"},
]
_GROUP = {tag: i for i, tags in enumerate(GROUPS) for tag in tags}
OTHER = len(GROUPS)
# Parts of class names and ids that tell what an element is for.
HINTS = [
    set("article articlebody content entry post story main text body blog read".split()),
    set("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot bottom copyright legal topbar sitemap toc".split()),
    set("sidebar side aside related recommended popular widget promo teaser more trending tags share social follow".split()),
    set("ad ads adv advert advertisement banner sponsor sponsored cookie cookies consent notice alert popup modal gdpr privacy".split()),
    set("form search login signup subscribe newsletter register contact".split()),
    set("comment comments reply replies discussion respond disqus reviews".split()),
]
_TOKEN = re.compile(r"[A-Z]?[a-z]+")
_MARK = re.compile(r"[©®™]|copyright|all rights reserved", re.I)
N_PLAIN = 11
N_FEATURES = OTHER + 1 + 2 * len(HINTS) + N_PLAIN
EDGES = 3  # to a run of text, to a plain element, to an element that says what it is for


@dataclass
class Forest:
    """The nodes of several pages; parents come before their children."""

    parent: np.ndarray
    levels: list[np.ndarray]  # nodes by depth
    leaf: np.ndarray
    edge: np.ndarray
    features: np.ndarray
    page: np.ndarray


def _hints(names: str) -> list[bool]:
    tokens = {t.lower() for t in _TOKEN.findall(names)}
    return [bool(tokens & h) for h in HINTS]


def forest(trees: list[Tree]) -> Forest:
    sizes = np.array([len(t.tag) for t in trees], np.int64)
    first = np.cumsum(sizes) - sizes
    page = np.repeat(np.arange(len(trees)), sizes)
    parent = np.concatenate([np.array(t.parent) for t in trees]) + first[page]
    parent[first] = -1
    n = len(parent)
    group = np.array([_GROUP.get(x, OTHER) for t in trees for x in t.tag], np.int64)
    named = np.zeros((n, len(HINTS)), bool)
    leaf = np.zeros(n, bool)
    sums = np.zeros((n, 6))  # characters, linked ones, marks, texts, paragraphs, characters before
    own = np.zeros((n, 4))
    i = 0
    for t in trees:
        before = 0
        for names, text in zip(t.names, t.leaf):
            if names:
                named[i] = _hints(names)
            if text is not None:
                s = text.text
                size = len(s)
                leaf[i] = True
                marks = s.count(".") + s.count(",") + s.count(";") + s.count(":") + s.count("!") + s.count("?") + s.count("。") + s.count("，")
                sums[i] = size, text.linked, marks, 1, 0, before
                own[i] = s.count(" ") + 1, s[-1] in ".!?。…", _MARK.search(s) is not None, sum(map(s.count, "0123456789")) / size
                before += size
            i += 1
    sums[leaf, 4] = group[leaf] == _GROUP["p"]
    # Depths: parents come first, so a level is complete once its parents are.
    levels, now = [], np.flatnonzero(parent < 0)
    order = np.argsort(parent, kind="stable")
    opens = np.searchsorted(parent[order], np.arange(n + 1))
    while len(now):
        levels.append(now)
        count = opens[now + 1] - opens[now]
        rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        now = order[np.repeat(opens[now], count) + rank]
    start = np.where(leaf, sums[:, 5], np.inf)
    best = own[:, 0].copy()
    for level in levels[:0:-1]:
        np.add.at(sums[:, :5], parent[level], sums[level, :5])
        np.minimum.at(start, parent[level], start[level])
        np.maximum.at(best, parent[level], best[level])
    depth = np.zeros(n)
    above = np.zeros((n, len(HINTS)), bool)  # what an element around the node is for
    for d, level in enumerate(levels):
        depth[level] = d
        if d:
            above[level] = above[parent[level]] | named[parent[level]]
    chars, texts = sums[:, 0], np.maximum(1, sums[:, 3])
    whole = np.maximum(1, chars[first])[page]
    place = np.where(np.isfinite(start), start + chars / 2, 0) / whole
    size = np.maximum(1, chars)
    plain = np.stack(
        [
            np.log1p(chars), sums[:, 1] / size, np.minimum(10 * sums[:, 2] / size, 2), np.log1p(chars / texts), chars / whole, place, place * place,
            np.log1p(depth), np.log1p(sums[:, 4]), np.log1p(best), own[:, 1] - own[:, 2] + own[:, 3] - 1,
        ],
        1,
    )
    one = np.zeros((n, OTHER + 1))
    one[np.arange(n), group] = 1
    features = np.concatenate((one, named, above, plain), 1)
    edge = np.where(leaf, 0, np.where(named.any(1) | (group < _GROUP["section"]), 2, 1))
    return Forest(parent, levels, leaf, edge, features, page)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # two rows: elements, runs of text
    moves: np.ndarray  # edge kind, parent's label, child's label

    def scores(self, f: Forest) -> np.ndarray:
        x = (f.features - self.mean) / self.scale
        out = np.zeros((len(x), 2))
        out[:, 1] = np.where(f.leaf, x @ self.weights[1, :-1] + self.weights[1, -1], x @ self.weights[0, :-1] + self.weights[0, -1])
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(x.take(0, axis), x.take(1, axis))


def messages(f: Forest, scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals per node, marginals per edge by its child, log of the sum over each page's labellings)."""
    up, sent = scores.copy(), np.zeros_like(scores)
    for level in f.levels[:0:-1]:
        sent[level] = _log_sum(moves[f.edge[level]] + up[level][:, None, :], 2)
        np.add.at(up, f.parent[level], sent[level])
    down, pair = np.zeros_like(scores), np.zeros((len(scores), 2, 2))
    for level in f.levels[1:]:
        above = f.parent[level]
        both = (up[above] + down[above] - sent[level])[:, :, None] + moves[f.edge[level]]
        down[level] = _log_sum(both, 1)
        pair[level] = both + up[level][:, None, :]
    whole = up + down
    total = _log_sum(whole, 1)
    single = np.exp(whole - total[:, None])
    child = np.concatenate(f.levels[1:]) if len(f.levels) > 1 else np.zeros(0, np.int64)
    pair[child] = np.exp(pair[child] - total[child][:, None, None])
    return single, pair, total[f.levels[0]]


def node_labels(f: Forest, marked: np.ndarray) -> np.ndarray:
    """Labels of all nodes from those of the runs of text: an element follows most of its characters."""
    chars = np.where(f.leaf, np.expm1(f.features[:, -N_PLAIN]), 0.0)
    inside = chars * marked
    for level in f.levels[:0:-1]:
        np.add.at(chars, f.parent[level], chars[level])
        np.add.at(inside, f.parent[level], inside[level])
    return (2 * inside > chars).astype(np.int64)


class Fit:
    """The penalised log-likelihood of labelled trees and its gradient; ``weight`` per page."""

    def __init__(self, f: Forest, labels: np.ndarray, weight: np.ndarray, l2: float = L2):
        self.f, self.labels, self.l2 = f, labels, l2
        self.mean, self.scale = f.features.mean(0), f.features.std(0)
        self.scale[self.scale < 1e-6] = 1.0
        self.weight = weight
        self.per_node = weight[f.page]
        x = np.concatenate(((f.features - self.mean) / self.scale, np.ones((len(labels), 1))), 1)
        self.kinds = [np.flatnonzero(~f.leaf), np.flatnonzero(f.leaf)]
        self.x = [x[at] for at in self.kinds]
        self.child = np.flatnonzero(f.parent >= 0)
        self.edges = [self.child[f.edge[self.child] == kind] for kind in range(EDGES)]
        self.seen = np.zeros((EDGES, 2, 2))
        np.add.at(self.seen, (f.edge[self.child], labels[f.parent[self.child]], labels[self.child]), self.per_node[self.child])

    def model(self, theta: np.ndarray) -> Model:
        cut = 2 * (N_FEATURES + 1)
        return Model(self.mean, self.scale, theta[:cut].reshape(2, -1), theta[cut:].reshape(EDGES, 2, 2))

    def scores(self, model: Model) -> np.ndarray:
        out = np.zeros((len(self.labels), 2))
        for at, x, w in zip(self.kinds, self.x, model.weights):
            out[at, 1] = x @ w
        return out

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        model = self.model(theta)
        single, pair, _ = messages(self.f, self.scores(model), model.moves)
        gap = (self.labels - single[:, 1]) * self.per_node
        weights = np.stack([x.T @ gap[at] for at, x in zip(self.kinds, self.x)])
        moves = self.seen - np.stack([(pair[at] * self.per_node[at][:, None, None]).sum(0) for at in self.edges])
        return np.concatenate((weights.ravel(), moves.ravel())) - self.l2 * theta

    def value(self, theta: np.ndarray) -> float:
        model, f = self.model(theta), self.f
        scores = self.scores(model)
        _, _, total = messages(f, scores, model.moves)
        given = self.per_node @ scores[np.arange(len(scores)), self.labels] + (self.seen * model.moves).sum()
        return float(given - total @ self.weight - self.l2 / 2 * theta @ theta)


def fit(f: Forest, labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Maximum likelihood with an L2 penalty; every page counts alike."""
    pages = int(f.page.max()) + 1
    task = Fit(f, labels, 1.0 / (np.bincount(f.page, minlength=pages) * pages))
    theta, m, v = np.zeros(2 * (N_FEATURES + 1) + 4 * EDGES), 0.0, 0.0
    for step in range(1, rounds + 1):
        g = task.gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return task.model(theta)


def sample(pages: DataFrame, n: int = SAMPLE_PAGES, longest: int = SAMPLE_CHARS, page: str = "html") -> list[str]:
    """Different pages that mark their article, by hash order: at most ``n`` of at most ``longest`` characters.

    Hashes are picked first, so that no task sends more than ``n`` numbers, then one page of each.
    """
    rows = pages.select(F.col(page).alias("page"), F.xxhash64(page).alias("key"))
    rows = rows.where((F.length("page") <= longest) & F.col("page").rlike(r"(?i)<(article|main)[\s>]"))
    keys = [r["key"] for r in rows.select("key").distinct().orderBy("key").limit(n).collect()]
    if not keys:
        return []
    # Hash order: the chosen keys are the smallest.
    one = rows.where(F.col("key") <= max(keys)).groupBy("key").agg(F.min("page").alias("page"))
    return [r["page"] for r in one.orderBy("key").collect()]


def train(pages: DataFrame | None = None, page: str = "html", rule_pages: int = RULE_PAGES) -> Model:
    """Fit on pages made by rule and, if given, on those of a table that mark their article."""
    rule = [read_page(x) for x in labelled_pages(rule_pages)]
    found = [read_page(x) for x in sample(pages, page=page)] if pages is not None else []
    f = forest(rule + found)
    marked = [leaf is not None and leaf.labelled for t in rule for leaf in t.leaf]
    marked += [leaf is not None and leaf.landmark for t in found for leaf in t.leaf]
    return fit(f, node_labels(f, np.array(marked)))


def extract(pages: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    trees = [read_page(p) for p in pages]
    if not trees:
        return []
    f = forest(trees)
    single, _, _ = messages(f, model.scores(f), model.moves)
    chosen = f.leaf & (single[:, 1] >= 0.5)
    texts: list[list[str]] = [[] for _ in trees]
    first = np.flatnonzero(f.parent < 0)
    for i in np.flatnonzero(chosen).tolist():
        p = int(f.page[i])
        texts[p].append(trees[p].leaf[i - int(first[p])].text)
    return ["\n\n".join(t) for t in texts]


def main_texts(pages: DataFrame, model: Model, page: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without the page column, with the main text and its number of characters."""
    added = {text.lower(), n_chars.lower(), page.lower()}
    keep = [f for f in pages.schema.fields if f.name.lower() not in added]
    schema = T.StructType([*keep, T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])
    names = [f.name for f in keep]

    def work(batches):
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            first = 0
            while first < len(raw):
                end, size = first, 0
                while end < len(raw) and (end == first or size < PIECE_CHARS):
                    size += len(raw[end] or "")
                    end += 1
                texts = extract([p or "" for p in raw[first:end]], model)
                part = [batch.column(i).slice(first, end - first) for i in range(len(names))]
                counts = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*part, pa.array(texts, pa.string()), counts], [*names, text, n_chars])
                first = end

    return pages.select(*names, page).mapInArrow(work, schema)
