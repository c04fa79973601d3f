"""Page model: marginals against enumeration, extraction on pages it has not seen."""

import time
from itertools import product
from math import exp
from random import Random

import pytest

from ledgerloom.llm import html_tree as T
from ledgerloom.llm.html_labelled import labelled_pages


@pytest.fixture(scope="module")
def model():
    return T.train(labelled_pages())


def test_sum_product_equals_enumeration(model):
    page = T.parse("<div class='ad'>x y</div><article><p>Some text of a page</p><ul><li><a href=x>l</a></li></ul></article>")
    seen = T._observations(page)
    total, mass = 0.0, [0.0] * len(page.elements)
    for labels in product((0, 1), repeat=len(page.elements)):
        score = model.root[labels[0]] + sum(model.unary.get(o, model.unseen)[y] for y, os in zip(labels, seen, strict=True) for o in os)
        score += sum(model.pair[labels[e.parent]][labels[i]] for i, e in enumerate(page.elements) if i)
        total += exp(score)
        for i, y in enumerate(labels):
            mass[i] += y * exp(score)
    assert T.marginals(page, model) == pytest.approx([m / total for m in mass])


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<script>var a = '</p>';</script><style>p{}</style>", ""),
    ("<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><article><h1>Title</h1><p>One  two\n three &amp; four<br><p>Five</article><footer>Copyright</footer>",
     "Title\n\nOne two three & four\n\nFive"),
    ("<main><h1>Title</h1><p>Body text one, which is rather long.</p><section class='comments'><p>Nice words from a reader</p></section></main><div class='cookie-banner'>We use cookies</div>",
     "Title\n\nBody text one, which is rather long."),
    ("<article><p>Text of an article that is cut off in the mid", "Text of an article that is cut off in the mid"),
])
def test_pages(model, html, text):
    assert T.main_text(html, model) == text


ARTICLE = "<article><h1>Title here</h1><p>The body text of the article goes on and on.</p><p>More.</p></article>"
PARTS = (
    "<footer><p>{}</p></footer>", "<aside><p>{}</p></aside>", "<section class=comments><p>{}</p></section>", "<div class='cookie-banner'><p>{}</p></div>",
    "<header><p>{}</p></header>", "<form><p>{}</p></form>", "<nav><ul><li>{}</li><li>Home page</li><li>News</li></ul></nav>",
    "<aside><article><h3>Another one</h3><p>{}</p></article></aside>",
)


@pytest.mark.parametrize("part", PARTS)
def test_other_parts_are_dropped_at_any_length(model, part):
    """Before, after and inside the article, once and several times."""
    for n in (30, 100, 150, 170, 300, 1000, 20_000):
        other = part.format(("word " * (n // 5)).strip())
        for page in (ARTICLE + other, other + ARTICLE, ARTICLE.replace("</article>", other + "</article>"), f"<html><body>{other * 3}{ARTICLE}</body></html>"):
            assert T.main_text(page, model) == "Title here\n\nThe body text of the article goes on and on.\n\nMore."


def unseen_layouts(n=400, seed=9):
    """(page, content blocks, other blocks) of layouts, names and words that the labelled pages don't have."""
    r, count = Random(seed), 0

    def words():
        nonlocal count
        count += 1
        return f"block{count} " + " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(r.choice((1, 3, 10, 25, 50, 90, 200))))

    def blocks(k, held):
        out = []
        for _ in range(k):
            texts = [words() for _ in range(r.choice((1, 1, 2)))]
            held += texts
            shape = r.choice(("<p>{}</p>", "<p>{}</p>", "<div><div>{}</div></div>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<h4>{}</h4>"))
            out += [shape.format(t) for t in texts]
        return "".join(out)

    shells = (
        "<div class='pager'>{}</div>", "<div id='branding'>{}</div>", "<div class='left rail'><div>{}</div></div>", "<section class='trending'>{}</section>",
        "<div class='sponsor box'>{}</div>", "<div role='dialog' class='modal'><div>{}</div></div>", "<div id='gdpr'>{}</div>", "<div id='disqus_thread'><ol>{}</ol></div>",
        "<section class='feedback'><div><div>{}</div></div></section>", "<form action='/r' class='register'>{}</form>", "<footer><div class='cols'><div>{}</div></div></footer>",
        "<header><div><div>{}</div></div></header>", "<nav><div>{}</div></nav>", "<aside><section><div>{}</div></section></aside>", "<div class='tabs'>{}</div>",
    )
    holders = (
        "<article><header2>{}</header2></article>", "<main><section><section>{}</section></section></main>", "<div id='story'><div class='x'>{}</div></div>",
        "<table><tr><td><article>{}</article></td></tr></table>", "<div class='prose'>{}</div>", "<article id='a1'><section>{}</section></article>",
    )
    for _ in range(n):
        content, other = [], []
        inside = blocks(r.randrange(1, 9), content) + (r.choice(shells).format(blocks(r.randrange(1, 4), other)) if r.random() < 0.4 else "")
        around = [r.choice(shells).format(blocks(r.randrange(1, 4), other)) for _ in range(r.randrange(6))]
        at = r.randrange(len(around) + 1)
        yield f"<html><body><div class='w'>{''.join(around[:at])}{r.choice(holders).format(inside)}{''.join(around[at:])}</div></body></html>", content, other


def test_precision_and_recall_of_blocks_on_unseen_layouts(model):
    right = wrong = missed = 0
    for page, content, other in unseen_layouts():
        found = set(T.main_text(page, model).split("\n\n"))
        right, missed = right + sum(b in found for b in content), missed + sum(b not in found for b in content)
        wrong += sum(b in found for b in other)
    print("precision", right / (right + wrong), "recall", right / (right + missed))
    assert right / (right + wrong) >= 0.95 and right / (right + missed) >= 0.95


def test_end_tags_without_a_start_take_linear_time(model):
    for page in ("<div>" * 60_000 + "</p>" * 60_000 + "x", "<li><section>" + "<figure>" * 30_000 + "<li></li>" * 30_000 + "x"):
        start = time.process_time()
        T.main_text(page, model)
        assert time.process_time() - start < 15


def test_deep_and_long_pages(model):
    assert T.main_text("<div>" * 3000 + "x", model) in ("", "x")
    long = " ".join(["word"] * 50_000)
    assert T.main_text(f"<article><p>{long}</p></article>", model) == long


def test_rows(frame, model):
    rows = [(1, "u", "<article><p>Text of the page, a full sentence.</p></article>"), (1, "u", "<article><p>Text of the page, a full sentence.</p></article>"), (None, None, None)]
    got = T.extract(frame(rows, "page_id long, url string, html string"), model).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "Text of the page, a full sentence.", 34)] * 2 + [(None, None, "", 0)], key=str)
    assert T.extract(frame([], "page_id long, url string, html string"), model).collect() == []
