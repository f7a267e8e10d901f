"""Main text: exact messages, the fit's gradient, held-out pages, and the registered query on pages that mark their article."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from vitalgrid.llm import main_text as M
from vitalgrid.llm.dom import read_page
from vitalgrid.llm.page_rules import labelled_pages
from vitalgrid.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return M.train()


def texts(page):
    return [leaf.text for leaf in read_page(page).leaf if leaf is not None]


@pytest.mark.parametrize(
    "page,expected",
    [
        ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<div>a<b>b</b> c<p>d<br>e</p>f</div>", ["ab c", "d e", "f"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p><b>x.<br><p>y</p>z", ["x.", "y", "z"]), ("a &amp;&lt;&copy &#x41;&nbsp;\n b", ["a &<© A b"]),
        ("<script>var t='</p>'</script>a<style>b</style><title>c</title><textarea>d</textarea>", ["a"]),
        ("<head><title>x</title>y<p>z", ["z"]), ("<noscript>a</noscript><template>b</template><button>c</button>d", ["d"]),
        ("a<!-- <p>b</p> -->c<!doctype x><?y?></>d", ["acd"]), ('<a title="x>y">a</a> <a title=don\'t>b</a>', ["a b"]),
        ("a </div></p> b</i>", ["a", "b"]), ("a < b <c", ["a < b"]), ("<div>a<button>b</div>c", ["a", "c"]), ("<P>A</P><DIV>B", ["A", "B"]),
        ("<b><p>a</b>b</p>c", ["ab", "c"]), ("<td>x<div>y</td>z", ["x", "y", "z"]), ("<script>a", []), ("<h1>a<h2>b</h2>", ["a", "b"]),
    ],
)
def test_blocks_of_a_page(page, expected):
    assert texts(page) == expected


def test_reading_is_linear():
    start = time.perf_counter()
    for s in ["<a '", "<", "<!--", "<div>", "<p><b>", '<a href="', "</x>", "<li>", "&", "<script>"]:
        read_page(s * 60_000)
    read_page("<b>" * 40_000 + "</i>" * 40_000)
    assert time.perf_counter() - start < 60


def small_forest(rng, pages=3):
    trees = [read_page(p) for p in ["<div class=nav><p>ab c.<p>d</div>e", "<main><h1>a b</h1>x, y<ul><li>q</ul></main>", "", "w"]][: pages + 1]
    f = M.forest(trees)
    return f, rng.integers(0, 2, len(f.parent))


def test_messages_equal_enumeration():
    rng = np.random.default_rng(4)
    f, _ = small_forest(rng)
    scores, moves = rng.normal(size=(len(f.parent), 2)), rng.normal(size=(M.EDGES, 2, 2))
    single, pair, total = M.messages(f, scores, moves)
    for page in range(f.page.max() + 1):
        nodes = np.flatnonzero(f.page == page)
        weights, ones, both = 0.0, np.zeros(len(f.parent)), np.zeros((len(f.parent), 2, 2))
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            y = dict(zip(nodes.tolist(), labels))
            s = sum(scores[i, y[i]] for i in y) + sum(moves[f.edge[i], y[f.parent[i]], y[i]] for i in y if f.parent[i] >= 0)
            w = np.exp(s)
            weights += w
            for i in y:
                ones[i] += w * y[i]
                if f.parent[i] >= 0:
                    both[i, y[f.parent[i]], y[i]] += w
        assert np.allclose(single[nodes, 1], ones[nodes] / weights) and np.isclose(total[page], np.log(weights))
        child = [i for i in nodes if f.parent[i] >= 0]
        assert np.allclose(pair[child], both[child] / weights)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(5)
    f, labels = small_forest(rng)
    task = M.Fit(f, labels, rng.random(f.page.max() + 1), l2=0.01)
    theta = rng.normal(size=2 * (M.N_FEATURES + 1) + 4 * M.EDGES) * 0.3
    g = task.gradient(theta)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        assert np.isclose(g[i], (task.value(theta + step) - task.value(theta - step)) / 2e-5, atol=1e-6)


def test_held_out_pages(model):
    hit = wrong = missed = 0
    for page in labelled_pages(150, seed=77):
        tree = read_page(page)
        found = M.extract([page], model)[0].split("\n\n")
        expected = [leaf.text for leaf in tree.leaf if leaf is not None and leaf.labelled]
        both = len(set(found) & set(expected))
        hit, wrong, missed = hit + both, wrong + len(set(found)) - both, missed + len(set(expected)) - both
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.95


def test_the_whole_tree_decides(model):
    """Short lines inside an article stay, long prose inside a notice, a form or a comment goes."""
    prose = "Many words follow one another here, and they make whole sentences of prose. Another one comes behind it."
    page = (
        f"<body><nav><a href=/a>Home</a></nav><div class='cookie-notice'><p>{prose}</p></div><article><h1>Head</h1><p>{prose} 1</p><p>Yes.</p>"
        f"<p>{prose} 2</p></article><section class=comments><p>{prose} 3</p></section><form><p>{prose} 4</p></form><footer>&copy; us. {prose}</footer>"
    )
    assert M.extract([page], model)[0] == f"Head\n\n{prose} 1\n\nYes.\n\n{prose} 2"


def article_blocks(page):
    """Blocks of the article of the given pages, by pattern: no general reader."""
    inside = page[page.index("<article>") + 9 : page.index("</article>")].replace("<b>", "").replace("</b>", "").replace("<br>", " ")
    found = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p)>", inside))
    return "\n\n".join(b for b in found if b)


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = QUERIES["op12_tree_main_text"](spark, FOLDER)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    expected = sorted((r["page_id"], r["url"], article_blocks(r["html"]), len(article_blocks(r["html"]))) for r in rows)
    assert sorted(map(tuple, got.collect())) == expected


def test_edges(spark, model):
    long_page = "<article><h1>T</h1>" + "".join(f"<p>Sentence number {i}, it is.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, 1), (2, "", 2), (3, "<script>x</script>", 3), (4, long_page, 4), (4, long_page, 5), (5, "<div>" * 3000 + "deep", 6), (None, "\x00<", 7)]
    pages = spark.createDataFrame(rows, "page_id long, html string, Text int").repartition(3)
    got = {}
    for r in M.main_texts(pages, model).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got[1] == got[2] == got[3] == [""] and len(got[4]) == 2 and got[4][0] == got[4][1]
    assert got[4][0].count("\n\n") == 20_000
    assert M.main_texts(pages.limit(0), model).count() == 0
    assert M.main_texts(pages, M.train(pages.limit(0))).count() == 7
