"""Labelled pages from which the potentials of the page model are counted.

Written for this purpose: common page layouts with filler text. data-label marks content and other elements; an
element without a label has its parent's. Content and all other parts draw the lengths of their paragraphs from the same
few values, so that the amount of text alone says little about its part in the page.
"""

from __future__ import annotations

from random import Random

_WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()
_LENGTHS = (1, 2, 4, 8, 15, 30, 60, 120, 250)

# Element and names of the parts that are not content.
_PARTS = {
    "menu": ("nav", ("nav", "navbar", "menu", "breadcrumbs", "pagination", "toc", "main-nav")),
    "header": ("header", ("header", "masthead", "banner", "topbar", "site-header")),
    "footer": ("footer", ("footer", "copyright", "colophon", "site-footer", "legal")),
    "side": ("aside", ("sidebar", "side", "widget", "related", "recommended", "popular-posts")),
    "advert": ("div", ("ad", "ads sponsored", "advert", "promo", "advertisement")),
    "notice": ("div", ("cookie-notice", "cookie-banner", "alert", "newsletter", "popup", "consent", "subscribe")),
    "comments": ("section", ("comments", "discussion", "replies", "respond", "comment-list")),
    "social": ("div", ("share", "social", "share-buttons", "follow")),
    "form": ("form", ("search", "login", "contact", "signup")),
}
_HOLDERS = (
    ("<article {}>", "</article>"), ("<article {}>", "</article>"), ("<main {}><article>", "</article></main>"), ("<main><article {}>", "</article></main>"),
    ("<div class='content' {}>", "</div>"), ("<div id='main' {}><section>", "</section></div>"),
    ("<div class='post-body entry' {}><div>", "</div></div>"), ("<div class='wrapper'><main {}>", "</main></div>"),
    ("<div {}>", "</div>"), ("<section {}>", "</section>"), ("<article class='post' {}><div class='entry-content'>", "</div></article>"),
)
_WRAPPERS = (("", ""), ("<div>", "</div>"), ("<div class='container'>", "</div>"), ("<div class='layout with-sidebar'>", "</div>"), ("<div id='page'><div class='row'>", "</div></div>"))


class _Writer:
    def __init__(self, seed: int):
        self.r = Random(seed)

    def text(self, most: int = 250) -> str:
        n = self.r.choice([k for k in _LENGTHS if k <= most])
        at = self.r.randrange(len(_WORDS))
        return " ".join(_WORDS[(at + i) % len(_WORDS)] for i in range(n)).capitalize() + "."

    def items(self, linked: bool, most: int = 4) -> str:
        tag = self.r.choice(("ul", "ul", "ol"))
        rows = [f"<a href='/{i}'>{self.text(most)}</a>" if linked else self.text(most) for i in range(self.r.randrange(2, 9))]
        return f"<{tag}>" + "".join(f"<li>{row}</li>" for row in rows) + f"</{tag}>"

    def blocks(self, n: int) -> str:
        """Paragraphs, headings, lists, quotes and the like, of any length."""
        kinds = (
            lambda: f"<p>{self.text()}</p>", lambda: f"<p>{self.text()}</p>", lambda: f"<p>{self.text()}</p>",
            lambda: f"<p>{self.text()} <a href='/x'>ut labore</a> {self.text()}</p>", lambda: f"<h2>{self.text(8)}</h2>",
            lambda: f"<div>{self.text()}</div>", lambda: self.items(False, 30), lambda: f"<div><p>{self.text()}</p><p>{self.text()}</p></div>",
            lambda: f"<blockquote><p>{self.text()}</p></blockquote>", lambda: f"<h3>{self.text(8)}</h3>",
        )
        return "".join(self.r.choice(kinds)() for _ in range(n))

    def content(self) -> str:
        rare = (
            lambda: "", lambda: "", lambda: f"<table><tr><th>{self.text(4)}</th><td>{self.text(30)}</td></tr></table>",
            lambda: f"<figure><figcaption>{self.text(30)}</figcaption></figure>", lambda: f"<pre>{self.text()}</pre>",
            lambda: f"<dl><dt>{self.text(4)}</dt><dd>{self.text(60)}</dd></dl>", lambda: f"<section>{self.blocks(2)}</section>",
        )
        return f"<h1>{self.text(15)}</h1>" + self.blocks(self.r.randrange(1, 9)) + self.r.choice(rare)()

    def part(self, label: str = "") -> str:
        """One part that is not content, named by its element, by class, id or role, or by both."""
        kind = self.r.choice(list(_PARTS))
        tag, names = _PARTS[kind]
        name = self.r.choice(names)
        named = self.r.choice((f"class='{name}'", f"id='{name.split()[0]}'", f"class='{name} x1'"))
        plain = tag in ("nav", "header", "footer", "aside", "form")
        tag, named = self.r.choice(((tag, ""), (tag, ""), (tag, named), ("div", named))) if plain else (self.r.choice((tag, "div", "section")), named)
        if kind == "header" and tag == "div" and self.r.random() < 0.3:
            named = "role='banner'"
        inner = {
            "menu": lambda: self.r.choice((self.items(True), self.items(True, 8), self.items(False), f"<a href='/'>{self.text(2)}</a> <a href='/a'>{self.text(2)}</a>")),
            "comments": self.comments, "social": lambda: self.r.choice((self.items(True), self.items(False), self.text(8))),
            "side": lambda: self.r.choice((self.blocks(2), self.items(True) + self.blocks(1), f"<h3>{self.text(4)}</h3>" + self.items(True), self.cards())),
            "form": lambda: self.blocks(1) + f"<label>{self.text(4)}</label><input name='q'>",
        }.get(kind, lambda: self.r.choice((self.blocks(1), self.blocks(3), self.text(), f"<h3>{self.text(4)}</h3>" + self.items(True), self.items(True) + self.blocks(1))))
        return f"<{tag} {named} {label}>{inner()}</{tag}>"

    def comments(self) -> str:
        one = self.r.choice(("<div class='comment'>{}</div>", "<div class='reply'><div>{}</div></div>", "<p>{}</p>", "<article class='comment'>{}</article>", "<div>{}</div>"))
        rows = [one.format(self.text() if one.startswith("<p") else self.blocks(1)) for _ in range(self.r.randrange(1, 5))]
        return self.r.choice(("", f"<h2>{self.text(2)}</h2>")) + "".join(rows)

    def cards(self) -> str:
        """Teasers of other articles, each an article element."""
        card = lambda: f"<article><h3><a href='/x'>{self.text(8)}</a></h3><p>{self.text(60)}</p></article>"
        return "".join(card() for _ in range(self.r.randrange(1, 5)))

    def page(self) -> str:
        other, own = "data-label='other'", "data-label='content'"
        inside = [self.part(other) for _ in range(self.r.choice((0, 0, 1, 2)))]
        first, rest = self.content(), "".join(inside)
        article = first + rest if self.r.random() < 0.7 else first + rest + self.blocks(2)
        style = self.r.random()
        if style < 0.12:  # nothing but content
            bare = self.r.choice((self.content(), self.text(), f"<html><body>{self.content()}</body></html>", f"<div><div>{self.content()}</div></div>"))
            return "<!--content-->" + bare
        if style < 0.22:  # blocks right in the body
            article = "".join(f"<{t} {own}>{self.text()}</{t}>" for t in ("h1", *("p",) * self.r.randrange(1, 8)))
        else:
            start, end = self.r.choice(_HOLDERS)
            article = start.format(own) + article + end
        before = "".join(self.part() for _ in range(self.r.randrange(4)))
        after = "".join(self.part() for _ in range(self.r.randrange(5)))
        start, end = self.r.choice(_WRAPPERS)
        body = self.r.choice(("<body>", "<body>", "<body class='single-post comments-open'>"))
        return f"<html><head><title>{self.text(8)}</title></head>{body}{start}{before}{article}{after}{end}</body></html>"


def labelled_pages(n: int = 3000, seed: int = 1) -> list[str]:
    """Pages that combine the layouts above at random, pages whose blocks stand in the body beside other parts, and
    pages that are nothing but content, marked by a leading comment."""
    writer = _Writer(seed)
    pages = [writer.page() for _ in range(n)]
    return [p.replace("data-label='content'", 'data-label="content"').replace("data-label='other'", 'data-label="other"') for p in pages]
