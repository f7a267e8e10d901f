"""Labelled web pages made by rule: content blocks carry ``data-content``.

Layouts vary in their elements, in whether names tell what an element is for, and in
what surrounds the article: menus, headers, notices, adverts, forms, sidebars, share bars, reader
comments and footers. Words are made of random syllables, so that nothing depends on a language.
"""

from __future__ import annotations

import random

# Names that pages give to their parts.
NAMES = {
    "main": ["content", "main-content", "post-content", "article-body", "entry-content", "story", "post", "blog-post", "text"],
    "nav": ["nav", "main-nav", "menu", "navbar", "site-navigation", "breadcrumb", "topbar"],
    "header": ["header", "site-header", "masthead", "page-header"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "legal"],
    "side": ["sidebar", "aside", "related", "popular-posts", "widget", "recommended", "more-stories", "tags"],
    "ad": ["ad", "ads", "advert", "banner", "sponsored", "ad-slot"],
    "notice": ["cookie-notice", "consent", "alert", "notice", "gdpr-banner", "popup"],
    "form": ["search-form", "newsletter", "login", "subscribe", "contact-form"],
    "comment": ["comments", "comment-list", "replies", "discussion"],
    "share": ["share", "social", "share-buttons", "follow"],
    "plain": ["wrap", "container", "row", "col-8", "inner", "box", "grid", "x1", "css-1q2w3e"],
}


class _Page:
    def __init__(self, rng: random.Random):
        self.rng = rng
        letters = rng.sample("abcdefghijklmnopqrstuvwxyzäéñößçдеиклмно", 16)
        sounds = ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(40)]
        self.words = ["".join(rng.choices(sounds, k=rng.randint(1, 4))) for _ in range(300)]
        self.telling = rng.random() < 0.7  # names tell what an element is for
        self.semantic = rng.random() < 0.5  # elements do
        self.noise = rng.random() < 0.15  # words with symbols stuck to them

    def line(self, low: int, high: int, end: str = "") -> str:
        words = self.rng.choices(self.words, k=self.rng.randint(low, high))
        if self.noise:
            words = [w + self.rng.choice(["", "***", "###", "%%%", "&amp;&amp;"]) for w in words]
        return " ".join(words).capitalize() + end

    def prose(self, low: int = 1, high: int = 6) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            s = self.line(3, 18)
            if " " in s and self.rng.random() < 0.5:
                s = s.replace(" ", ", ", 1)
            out.append(s + self.rng.choice("...!?"))
        text = " ".join(out)
        if self.rng.random() < 0.15:
            text += f' <a href="/x">{self.line(1, 4)}</a>.'
        if self.rng.random() < 0.1:
            text = f"<b>{self.line(1, 3)}</b> {text}"
        return text

    def box(self, kind: str, tag: str, inside: str) -> str:
        """An element of one kind, by name, by element, or by neither."""
        tag = tag if self.semantic and self.rng.random() < 0.8 else "div"
        name = self.rng.choice(NAMES[kind] if self.telling and self.rng.random() < 0.85 else NAMES["plain"])
        how = self.rng.choice(["class", "class", "id"])
        return f'<{tag} {how}="{name}">{inside}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.line(1, 4)}</a>' for i in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(items)

    def advert(self) -> str:
        return self.box("ad", "aside", self.rng.choice([self.prose(1, 3), f'<a href="/b">{self.line(2, 8)}</a>', f"<p>{self.prose(1, 2)}</p>"]))

    def form(self) -> str:
        parts = f"<label>{self.line(1, 4)}</label><input>{self.rng.choice([f'<p>{self.prose(1, 3)}</p>', self.line(2, 9, '.')])}<button>ok</button>"
        form = f'<form action="/s">{parts}</form>'
        return form if self.rng.random() < 0.5 else self.box("form", "section", form)

    def article(self) -> str:
        rng, mark = self.rng, ' data-content="1"'
        title = f"<h1{mark}>{self.line(2, 12)}</h1>"
        parts = [title]
        for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 25])):
            kind = rng.random()
            if kind < 0.72:
                parts.append(f"<p{mark}>{self.prose()}" + rng.choice(["</p>", "</p>", ""]))
            elif kind < 0.78:
                parts.append(f"<h2{mark}>{self.line(1, 7)}</h2>")
            elif kind < 0.83:
                parts.append(f"<p{mark}>{self.line(1, 4)}{rng.choice(['', '.', '<br>'])}</p>")
            elif kind < 0.87:
                parts.append("<ul>" + "".join(f"<li{mark}>{self.line(1, 14)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif kind < 0.90:
                parts.append(f"<blockquote{mark}>{self.prose(1, 3)}</blockquote>")
            elif kind < 0.92:
                cells = "".join(f"<td{mark}>{self.line(1, 3)}</td>" for _ in range(3))
                parts.append(f"<table><tr>{cells}</tr><tr>{cells}</tr></table>")
            elif kind < 0.94:
                parts.append(f"<figure><img><figcaption{mark}>{self.line(3, 12)}</figcaption></figure>")
            elif kind < 0.97:
                parts.append(self.advert())
            else:
                parts.append(self.box("side", "aside", self.links(2, 4)))
        inside = "".join(parts)
        if rng.random() < 0.3:
            inside = self.box("plain", "section", inside)
        if rng.random() < 0.3:
            inside += self.box("share", "div", self.links(2, 5))
        if rng.random() < 0.15:
            inside += self.comments()
        return self.box("main", rng.choice(["article", "main"]), inside)

    def comments(self) -> str:
        items = "".join(f"<div><b>{self.line(1, 2)}</b> <p>{self.prose(1, 3)}</p></div>" for _ in range(self.rng.randint(1, 8)))
        return self.box("comment", "section", f"<h3>{self.line(1, 3)}</h3>{items}")

    def page(self) -> str:
        rng = self.rng
        often = lambda p, f: f() if rng.random() < p else ""
        nav = self.box("nav", "nav", self.links(3, 9))
        head = often(0.6, lambda: self.box("header", "header", f"<p>{self.line(1, 4)}</p>" + often(0.4, lambda: self.links(2, 5))))
        notice = often(0.35, lambda: self.box("notice", "div", f"<p>{self.prose(1, 3)}</p>" + often(0.5, lambda: f'<a href="/p">{self.line(1, 3)}</a>')))
        teasers = lambda: "".join(f'<h4><a href="/r">{self.line(2, 8)}</a></h4><p>{self.line(4, 14, "...")}</p>' for _ in range(rng.randint(1, 4)))
        side = often(0.5, lambda: self.box("side", "aside", f"<h3>{self.line(1, 3)}</h3>" + rng.choice([self.links(3, 8), teasers()])))
        end = f"{rng.choice(['&copy; ', 'Copyright ', ''])}{self.line(1, 3)} {rng.choice(['2024', '&middot;', '-'])} {self.prose(1, 2)}"
        foot = self.box("footer", "footer", rng.choice([end, f"<p>{end}</p>", self.links(2, 6) + f"<p>{end}</p>"]))
        body = [rng.choice([nav + head, head + nav]), notice, often(0.5, self.advert), often(0.4, self.form)]
        middle = self.article() + often(0.35, self.comments) + often(0.2, self.advert)
        body += [rng.choice([side + middle, middle + side]), often(0.4, self.form), foot]
        inside = "".join(body)
        if rng.random() < 0.3:
            inside = f'<div class="{rng.choice(NAMES["plain"])}">{inside}</div>'
        return f"<html><head><title>{self.line(1, 5)}</title></head><body>{inside}</body></html>"


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    """``n`` pages, the same for a seed."""
    return [_Page(random.Random(seed * 1_000_003 + i)).page() for i in range(n)]
