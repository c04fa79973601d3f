"""Main text of web pages by a tree-structured graphical model.

The elements of a page that make blocks form a tree. Each has a hidden label, content or not; potentials connect the
labels of parent and child, and each element's tag, name hints, amount of text, share of link text and the nearest named
parts it stands in depend on its label. Sum-product messages go up and down the tree once and give every element's exact content marginal. All
potentials are counted, with smoothing, on labelled pages (`html_labelled.py`).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr br img input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style noscript template head title svg iframe object select button textarea option datalist canvas audio video map".split())
_RAW = frozenset("script style textarea title iframe".split())
_CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
_SCOPES = frozenset("ul ol dl table body article section aside nav main div td th".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']++|[\"'])*?)(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Words in class, id and role that hint at an element's part in the page.
_HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header masthead banner topbar logo branding",
    "footer": "footer foot copyright legal colophon bottom",
    "side": "sidebar side aside complementary widget rail related recommended recommendations popular trending",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense outbrain taboola",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe paywall disclaimer announcement",
    "comments": "comment comments reply replies disqus discussion respond feedback reader",
    "social": "share social follow sharing tags meta byline author",
    "form": "form search login signup register contact",
    "content": "article content main post entry story body text blog prose page",
}
_HINT_OF = {word: hint for hint, words in _HINTS.items() for word in words.split()}
_PARTS = frozenset("nav header footer aside form article main".split())
_STRONG = ("advert", "comments", "notice", "menu", "side", "footer", "form", "header", "social", "content")


@dataclass
class Element:
    tag: str
    parent: int
    hint: str
    label: str | None = None
    chars: int = 0
    linked: int = 0
    marks: tuple[str, str] = ("none", "none")  # the part of the page it is or stands in, and the part around that


@dataclass
class Page:
    """Elements in page order (parents first) and blocks: (element, text)."""

    elements: list[Element]
    blocks: list[tuple[int, str]]


def _hint(attributes: str) -> str:
    if "=" not in attributes:
        return "none"
    found = set()
    for m in _NAMES.finditer(attributes):
        for word in _SPLIT.findall(m[1] or m[2] or m[3] or ""):
            found.add(_HINT_OF.get(word.lower()))
    return next((h for h in _STRONG if h in found), "none")


def _marks(tag: str, hint: str, parent: Element) -> tuple[str, str]:
    """An element that has a hint or a telling tag is a part of its own; classes of the whole page say nothing."""
    own = "none" if tag in ("html", "body") else hint if hint != "none" else tag if tag in _PARTS else "none"
    return parent.marks if own in ("none", parent.marks[0]) else (own, parent.marks[0])


def parse(html: str) -> Page:
    """Element tree and text blocks of a page, in time linear in its length. Missing end tags are implied as browsers do for paragraphs, items and
    cells; an end tag without a start is ignored; a cut-off tag or comment ends the page. A line break inside a
    block is white space."""
    elements = [Element("page", -1, "none")]
    open_: list[tuple[str, int]] = [("page", 0)]  # (tag, element); hidden ones carry their parent's element
    blocks: list[tuple[int, str]] = []
    text: list[str] = []
    depths: defaultdict[str, list[int]] = defaultdict(list)  # where each tag is open
    linked = hidden = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block:
                at = open_[-1][1]
                blocks.append((at, block))
                elements[at].chars += len(block)
                elements[at].linked += min(linked, len(block))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal hidden, in_link
        flush()
        for t, _ in open_[depth:]:
            depths[t].pop()
            hidden -= t in _HIDDEN
        del open_[depth:]
        in_link = False

    at = 0
    while at < len(html):
        token = _TOKEN.search(html, at)
        end = token.start() if token else len(html)
        if end > at and not hidden:
            text.append(html[at:end])
            if in_link:
                linked += end - at
        if not token:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if tag == "a":
                in_link = False
            if tag not in _INLINE:
                if depths[tag]:
                    close(depths[tag][-1])
            continue
        if tag in _INLINE:
            if tag == "br":
                text.append(" ")
            in_link = in_link if tag != "a" else True
            continue
        if tag in _RAW and not token[3].rstrip().endswith("/"):
            ended = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = ended.end() if ended else len(html)
            continue
        flush()
        if tag in _VOID:
            continue
        if open_[-1][0] == "p":
            close(len(open_) - 1)
        if tag in _CLOSES:
            latest = lambda tags: max((depths[t][-1] for t in tags if depths[t]), default=0)
            ended = latest(_CLOSES[tag])
            if ended > latest(_SCOPES - _CLOSES[tag]):
                close(ended)
        if tag == "body" and hidden:  # a head left open
            close(next(d for d, (t, _) in enumerate(open_) if t in _HIDDEN))
        if tag in _HIDDEN:
            hidden += 1
            depths[tag].append(len(open_))
            open_.append((tag, open_[-1][1]))
        else:
            label = re.search(r"data-label=\"(\w+)\"", token[3]) if "data-label" in token[3] else None
            parent, hint = open_[-1][1], _hint(token[3])
            elements.append(Element(tag, parent, hint, label and label[1], marks=_marks(tag, hint, elements[parent])))
            depths[tag].append(len(open_))
            open_.append((tag, len(elements) - 1))
    flush()
    return Page(elements, blocks)


def _amount(n: int) -> str:
    return "none" if not n else "short" if n < 40 else "middle" if n < 160 else "long"


def _observations(page: Page) -> list[tuple[str, ...]]:
    """Per element: tag with the share of link text, hint, amounts of text of its own and with all it contains, and the
    parts of the page around it."""
    chars, linked = [e.chars for e in page.elements], [e.linked for e in page.elements]
    for i in range(len(page.elements) - 1, 0, -1):
        chars[page.elements[i].parent] += chars[i]
        linked[page.elements[i].parent] += linked[i]
    out = []
    for e, n, k in zip(page.elements, chars, linked, strict=True):
        share = "no" if not k else "some" if k < 0.5 * n else "most"
        out.append((f"tag {e.tag} {share}", f"hint {e.hint}", f"amount {_amount(n)}", f"own {_amount(e.chars)}", f"in {e.marks[0]}", f"around {e.marks[1]}"))
    return out


@dataclass(frozen=True)
class TreeModel:
    """Log potentials; index 1 is content. `unary`: per observation, `pair[parent][child]`."""

    unary: dict[str, tuple[float, float]]
    unseen: tuple[float, float]
    pair: tuple[tuple[float, float], tuple[float, float]]
    root: tuple[float, float]


def train(pages: Iterable[str], smoothing: float = 0.1) -> TreeModel:
    """Count the potentials on pages whose elements carry data-label="content" or "other"; an element without one
    has its parent's label. The page itself is content if it opens with a comment that says so."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    pairs: Counter = Counter()
    roots: Counter = Counter()
    for html in pages:
        page = parse(html)
        labels: list[int] = []
        whole = int(html.startswith("<!--content-->"))
        roots[whole] += 1
        for e, observed in zip(page.elements, _observations(page), strict=True):
            y = whole if e.parent < 0 else labels[e.parent] if e.label is None else int(e.label == "content")
            labels.append(y)
            seen[y].update(observed)
            if e.parent >= 0:
                pairs[labels[e.parent], y] += 1
    kinds = {o.split()[0] for y in (0, 1) for o in seen[y]}
    sizes = {k: len({o for y in (0, 1) for o in seen[y] if o.startswith(k + " ")}) + 1 for k in kinds}
    totals = {(y, k): sum(n for o, n in seen[y].items() if o.startswith(k + " ")) for y in (0, 1) for k in kinds}
    value = lambda y, o: log((seen[y][o] + smoothing) / (totals[y, o.split()[0]] + smoothing * sizes[o.split()[0]]))
    unary = {o: (value(0, o), value(1, o)) for o in {*seen[0], *seen[1]}}
    pair = tuple(
        tuple(log((pairs[a, b] + smoothing) / (pairs[a, 0] + pairs[a, 1] + 2 * smoothing)) for b in (0, 1)) for a in (0, 1)
    )
    root = tuple(log((roots[y] + smoothing) / (sum(roots.values()) + 2 * smoothing)) for y in (0, 1))
    return TreeModel(unary, (0.0, 0.0), pair, root)


def _add(a: float, b: float) -> float:
    return a + log(1 + exp(b - a)) if a > b else b + log(1 + exp(a - b))


def marginals(page: Page, model: TreeModel) -> list[float]:
    """Content probability of each element by sum-product, upward then downward, in log space."""
    n = len(page.elements)
    own = [[0.0, 0.0] for _ in range(n)]
    for i, observed in enumerate(_observations(page)):
        for o in observed:
            u = model.unary.get(o, model.unseen)
            own[i][0] += u[0]
            own[i][1] += u[1]
    pair, up = model.pair, [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):  # children come after their parents
        a, b = own[i]
        up[i] = (_add(pair[0][0] + a, pair[0][1] + b), _add(pair[1][0] + a, pair[1][1] + b))
        above = own[page.elements[i].parent]
        above[0] += up[i][0]
        above[1] += up[i][1]
    down, out = [model.root] * n, [0.0] * n
    for i in range(n):
        if i:
            p = page.elements[i].parent
            a = own[p][0] + down[p][0] - up[i][0]
            b = own[p][1] + down[p][1] - up[i][1]
            down[i] = (_add(pair[0][0] + a, pair[1][0] + b), _add(pair[0][1] + a, pair[1][1] + b))
        gap = own[i][0] + down[i][0] - own[i][1] - down[i][1]
        out[i] = 1 / (1 + exp(min(max(gap, -700), 700)))
    return out


def main_text(html: str | None, model: TreeModel) -> str:
    """Blocks of elements that are rather content than not, white space normalised, joined by empty lines."""
    if not html:
        return ""
    page = parse(html)
    content = marginals(page, model)
    return "\n\n".join(text for at, text in page.blocks if content[at] >= 0.5)


def extract(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages` (page_id, url, html). Null and empty pages, and pages without
    content, have an empty text. Rows with null or repeated page_id are extracted like any other; other columns are
    ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, model) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
