"""Block trees of web pages: block elements and the runs of text between their borders.

Inline elements belong to the text around them. Elements without text are left out. A
page is read in one pass: a tag ends at its ``>`` or with the page, so no
input is read twice. Elements that close themselves by the next one (paragraphs, list
items, cells) do so here, unknown end tags are passed over, and whatever is open at the end closes.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# The element names of HTML.
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
BLOCKS = {
    "html", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "fieldset", "p", *HEADINGS, "hgroup",
    "ul", "ol", "dl", "menu", "li", "dd", "dt", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure",
    "figcaption", "details", "summary", "address", "dialog", "center", "legend", "search", "hr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
HIDDEN = {"head", "noscript", "template", "svg", "select", "datalist", "button", "object", "canvas", "video", "audio"}
HEAD_PARTS = {"meta", "link", "base", "title", "script", "style", "noscript", "template", "head"}
CLOSES_P = BLOCKS - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "legend"}
#: What a start tag closes, and the elements that it does not look beyond.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
} | {h: (set(HEADINGS), {"div", "section", "article", "td", "th", "li"}) for h in HEADINGS}
CELLS = {"td", "th", "caption", "table"}
TABLE = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+)(?P<close>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|data-content)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


@dataclass
class Leaf:
    """A run of text: its characters in links, and whether it lies in an article or under a label."""

    text: str
    linked: int
    landmark: bool
    labelled: bool


@dataclass
class Tree:
    """Nodes in page order, parents first; node 0 is the page."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    names: list[str] = field(default_factory=lambda: [""])
    leaf: list[Leaf | None] = field(default_factory=lambda: [None])

    def add(self, parent: int, tag: str, names: str, leaf: Leaf | None = None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.leaf.append(leaf)
        return len(self.tag) - 1


class _Open:
    """An open element; ``node`` is set with its first text."""

    __slots__ = ("tag", "names", "node", "hidden", "landmark", "labelled")

    def __init__(self, tag: str, names: str, above: _Open | None, labelled: bool = False):
        self.tag, self.names, self.node = tag, names, -1
        self.hidden = tag in HIDDEN or (above is not None and above.hidden)
        inside = above is not None and above.landmark
        self.landmark = tag in ("article", "main") or (inside and tag not in ("nav", "aside", "footer", "form"))
        self.labelled = labelled or (above is not None and above.labelled)


class _Reader:
    def __init__(self):
        self.tree = Tree()
        self.page = _Open("html", "", None)
        self.page.node = 0
        self.stack = [self.page]
        self.count: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        """A block begins or ends: the text so far is a leaf of the innermost open block."""
        if not self.text:
            return
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            home = 0
            first = len(self.stack)
            while self.stack[first - 1].node < 0:
                first -= 1
            home = self.stack[first - 1].node
            for entry in self.stack[first:]:
                if entry.tag in BLOCKS:
                    home = self.tree.add(home, entry.tag, entry.names)
                entry.node = home
            top = self.stack[-1]
            self.tree.add(home, self.tree.tag[home], "", Leaf(text, min(self.linked, len(text)), top.landmark, top.labelled))
        self.linked = 0

    def say(self, raw: str) -> None:
        if raw and not self.stack[-1].hidden:
            text = html.unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if self.count.get("a"):
                self.linked += len(text.strip())

    def pop_to(self, i: int) -> None:
        self.flush()
        for entry in self.stack[i:]:
            self.count[entry.tag] -= 1
        del self.stack[i:]

    def find(self, tags: set[str], beyond: set[str]) -> int:
        """The innermost open element among ``tags``, not looking past ``beyond``; 0 if none."""
        if any(self.count.get(t) for t in tags):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in tags:
                    return i
                if self.stack[i].tag in beyond:
                    return 0
        return 0

    def start(self, tag: str, attributes: str) -> None:
        if self.count.get("head") and tag not in HEAD_PARTS:
            self.pop_to(self.find({"head"}, set()))
        if tag == "br":
            self.say(" ")
        if tag in CLOSES_P and self.count.get("p"):
            i = self.find({"p"}, CELLS)
            if i:
                self.pop_to(i)
        if tag in CLOSED_BY:
            i = self.find(*CLOSED_BY[tag])
            if i:
                self.pop_to(i)
        if tag in BLOCKS:
            self.flush()
        if tag in VOID or (tag in ("html", "body") and self.count.get(tag)):
            return
        names, labelled = "", False
        if tag in BLOCKS and attributes:
            for name, value in _HINT.findall(attributes):
                if name.lower() == "data-content":
                    labelled = True
                else:
                    names += " " + value.strip("\"'")
        self.stack.append(_Open(tag, names, self.stack[-1], labelled))
        self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "p" or tag == "br":
            self.flush() if tag == "p" else self.say(" ")
        if not self.count.get(tag):
            return
        if tag not in BLOCKS and tag not in HIDDEN:
            i = self.find({tag}, set())
            if all(e.tag not in BLOCKS for e in self.stack[i:]):
                for entry in self.stack[i:]:
                    self.count[entry.tag] -= 1
                del self.stack[i:]
            else:  # ends outside the block in which it stands
                self.count[tag] -= 1
                del self.stack[i]
            return
        i = self.find({tag}, set() if tag in TABLE else CELLS)
        if i:
            self.pop_to(i)


def read_page(page: str) -> Tree:
    """The block tree of a page."""
    reader, at = _Reader(), 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            break
        reader.say(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None or not m["close"]:
            continue
        tag = name.lower()
        if m["end"]:
            reader.end(tag)
            continue
        reader.start(tag, m["attributes"])
        if tag in RAW:
            close = _ENDS[tag].search(page, at)
            at = close.start() if close else len(page)
    reader.say(page[at:])
    reader.flush()
    return reader.tree
