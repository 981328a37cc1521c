"""Page extraction: hand-made pages, messages against enumeration, and pages without labels."""

import itertools
import math
import random
import time

import pytest

from autostrata.llm import html_extract as h


def _page(body, article=True):
    inner = f"<article>{body}</article>" if article else body
    return (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body>"
        "<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav><!-- <p>no</p> -->"
        f'<div class="ad">Buy now.</div>{inner}<footer>&copy; somebody</footer></body></html>'
    )


def _pages(spark):
    random.seed(3)
    paragraphs = lambda: "".join(
        f"<p>{' '.join(random.choices(['one', 'two', 'three'], k=random.randint(3, 40)))}.</p>"
        for _ in range(random.randint(1, 6))
    )
    rows = [(i, "u", _page(f"<h1>Title {i} here</h1>{paragraphs()}")) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (101, "u", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def model(spark):
    return h.fit(_pages(spark))


def test_only_the_article_is_left(spark, model):
    rows = h.extract(_pages(spark), model).collect()
    assert len(rows) == 63
    for r in rows:
        if r.html:
            inner = r.html.split("<article>")[1].split("</article>")[0]
            lines = inner.replace("</h1>", "\n").replace("</p>", "\n").replace("<h1>", "").replace("<p>", "")
            assert r.text == lines.strip()
        else:
            assert r.text == ""


def test_references_white_space_and_open_tags(model):
    body = "<h1>A &amp;&eacute;&#x21;</h1><p>a  b\n<b>c</b>d<script>x</script><p>e<br>f<ul><li>g<li>h</ul>"
    assert h.main_text(_page(body), model) == "A &é!\na b cd\ne f\ng\nh"


def test_asides_inside_the_article_go(model):
    body = (
        "<h1>Title of it</h1><p>First paragraph, with some words.</p><aside>See also</aside>"
        '<div class="ad">Buy</div><p>Second paragraph, with words.</p><form>Mail <input></form>'
        '<section id="comments"><p>First!</p><p>I do not agree with this.</p></section>'
    )
    assert h.main_text(_page(body), model) == (
        "Title of it\nFirst paragraph, with some words.\nSecond paragraph, with words."
    )


def test_marginals_equal_enumeration():
    random.seed(7)
    for _ in range(20):
        blocks = [h.Block(-1, "html", frozenset())]
        for i in range(1, 7):
            blocks.append(h.Block(random.randrange(i), f"x{i}", frozenset()))
        model = h.TreeModel({f"tag x{i}": random.uniform(-2, 2) for i in range(1, 7)}, (0.2, 0.7))
        weights = {}
        for values in itertools.product((0, 1), repeat=7):
            weight = math.exp(h._PAGE) if values[0] else 1.0
            for i in range(1, 7):
                p = model.ties[values[blocks[i].parent]]
                weight *= (p if values[i] else 1 - p) * (
                    math.exp(model.evidence[f"tag x{i}"]) if values[i] else 1
                )
            weights[values] = weight
        total = sum(weights.values())
        wanted = [sum(w for v, w in weights.items() if v[i]) / total for i in range(7)]
        assert model.marginals(blocks) == pytest.approx(wanted)


def test_without_labelled_pages(spark):
    pages = spark.createDataFrame([(1, "<p>x")], "page_id long, html string")
    model = h.fit(pages)
    assert h.fit(pages.limit(0)) == model
    text = "A long enough paragraph of the story, with some words in it, and more of them. " * 3
    assert text.strip() in h.main_text(_page(f'<div class="post"><p>{text}</p></div>', False), model)


def test_odd_markup_does_not_fail(model):
    for page in ("<", "<p", "<a b='", "</p></div>", "<!--", "<script>", "a<b", "<p>" * 3000, "x" * 10**6):
        assert isinstance(h.main_text(page, model), str)


_BODY = "<h1>Title of it</h1>" + "<p>First paragraph, with some words in it.</p>" * 4
_TEXT = "\n".join(["Title of it"] + ["First paragraph, with some words in it."] * 4)


@pytest.mark.parametrize(
    "start,end",
    [
        ('<div class="layout with-sidebar">', "</div>"),
        ('<div id="search-wrapper">', "</div>"),
        ('<div class="long-form">', "</div>"),
        ('<div class="sidebar">', "</div>"),
        ('<form id="form1"><div class="header-notice">', "</div></form>"),
        ('<main><div class="with-sidebar">', "</div></main>"),
    ],
)
def test_names_around_the_main_part_do_not_bar_it(model, start, end):
    page = _page(_BODY).replace("<article>", f"{start}<article>").replace("</article>", f"</article>{end}")
    page = page.replace(end, f'<div class="sidebar"><p>More of our many stories, here.</p></div>{end}')
    assert h.main_text(page, model) == _TEXT
    truth = h.labels(h.parse(page)[0])
    assert sum(x == 1 for x in truth) >= 6


@pytest.mark.parametrize("title", ['<h1 class="post-header">', '<header class="entry-header"><h1>', "<header><h1>"])
def test_named_titles_stay(model, title):
    assert h.main_text(_page(_BODY.replace("<h1>", title)), model) == _TEXT


def test_names_can_be_overruled_without_a_declared_part(model):
    body = f'<div class="long-form">{_BODY}</div>'
    assert h.main_text(_page(body, article=False), model) == _TEXT


def test_many_comments_stay_out(model):
    comment = '<article class="comment"><p>I do not agree with this, and have more words.</p></article>'
    for name in ("comments", "comments-area", "comment-list"):
        body = f'{_BODY}<section id="{name}">{comment * 12}{"<p>Nor do I, to be honest.</p>" * 12}</section>'
        assert h.main_text(_page(body), model) == _TEXT
    page = _page(_BODY).replace("<body>", "<body><header><h1>Name of the site</h1></header>")
    page = page.replace("<body>", '<body><div class="cookie-banner"><p>We use cookies on this site.</p></div>')
    assert h.main_text(page, model) == _TEXT


@pytest.mark.parametrize(
    "piece",
    ["<script", "<a", "<a b", "<!-- ", "<div>", "<p>", "<table><td><div>", "<ul><li><b>", "<svg>", "<noscript>",
     "</x>", "<a href='", "<", "&lt", "<i><div>"],
)
@pytest.mark.parametrize("tail", ["", "x>"])
def test_broken_pages_take_linear_time(model, piece, tail):
    page = _page("<p>Some words.</p>").replace("</article>", piece * (300_000 // len(piece)) + tail)
    start = time.perf_counter()
    h.main_text(page, model)
    assert time.perf_counter() - start < 8


def test_one_long_tag(model):
    start = time.perf_counter()
    h.main_text(_page("<p>Words.</p><" + "a" * 1_000_000), model)
    h.main_text(_page("<p>Words.</p><a " + "b=c " * 250_000), model)
    assert time.perf_counter() - start < 5


def test_copies_count_once_and_only_declaring_pages_are_taken(spark, monkeypatch):
    pages = _pages(spark)
    others = [(i, "u", f"<html><body><p>text {i}</p></body></html>") for i in range(200, 400)]
    copies = [(i, "u", _page("<h1>Copy</h1><p>of it</p>")) for i in range(400, 500)]
    more = pages.union(spark.createDataFrame(others + copies, pages.schema))
    seen = []
    monkeypatch.setattr(h, "_model", lambda counts: seen.append(counts))
    h.fit(pages)
    h.fit(more)
    # One page more than before, with one <h1> in its article.
    first, second = (sum(n for k, (_, n) in c.items() if k.startswith("tag h1 ")) for c in seen)
    assert second == first + 1
