"""Links of crawled pages."""

import time

import pytest

from autostrata.sources import container_links, linked_files

PAGE = """<html><body>
<a href="/outside/combustivel.xlsx">no</a>
<!-- <div id="parent-fieldname-text"><a href="/comment/combustivel">no</a></div> -->
<DIV class="x" id="parent-fieldname-text">
  <div><p><a class="k" href="http://h/a/D_COMBUSTIVEL_Abril_2024.xlsx">yes</a></p></div>
  <a href=''>empty</a> <a name="anchor">none</a> <a data-href="/combustivel/data">no</a>
  <a href='/b/Combustivel_maio'>yes</a><a href="/other.xlsx">no keyword</a>
  <script>var x = '<a href="/script/combustivel">';</script>
  <abbr href="/abbr/combustivel">no</abbr>
  <a href=/c/combustivel?x=1&amp;y=2 target=_blank>yes</a>
</DIV>
<div id="parent-fieldname-text"><a href="/second/combustivel">no</a></div>
</body></html>"""


def _links(spark, html, **options):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = container_links(pages, **options).orderBy("nr_posicao").collect()
    assert [r.nr_posicao for r in rows] == list(range(len(rows)))
    return [r.href for r in rows]


def test_links_of_the_first_container(spark):
    assert _links(spark, PAGE) == [
        "http://h/a/D_COMBUSTIVEL_Abril_2024.xlsx",
        "/b/Combustivel_maio",
        "/c/combustivel?x=1&y=2",
    ]


def test_other_containers_and_no_keyword(spark):
    html = "<nav><a href='/1'>x</a><nav><a href='/2'>y</a></nav><a href='/3'>z</a></nav><a href='/4'>"
    assert _links(spark, html, tag="nav", element_id=None, keyword=None) == ["/1", "/2", "/3"]


def test_page_without_container(spark):
    assert _links(spark, "<div id='other'><a href='/combustivel'>x</a></div>") == []
    assert _links(spark, None) == []


def test_unclosed_container_reaches_to_the_end(spark):
    html = "<div id=parent-fieldname-text><a href='/combustivel/1'>x</a><p><a href='/combustivel/2'>"
    assert _links(spark, html) == ["/combustivel/1", "/combustivel/2"]


def test_linked_files(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    rows = linked_files(container_links(pages)).orderBy("nr_posicao").collect()
    assert [r.nm_file for r in rows] == [
        "D_COMBUSTIVEL_Abril_2024.xlsx", "combustivel_1.xlsx", "combustivel_2.xlsx",
    ]


def test_links_need_no_shuffle(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    plan = linked_files(container_links(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def _inside(spark, inner):
    return _links(spark, f"<nav>{inner}</nav><a href='/out'>", tag="nav", element_id=None, keyword=None)


def test_elements_closed_by_themselves_do_not_count(spark):
    assert _inside(spark, "<nav/><a href='/1'>x</a>") == ["/1"]


def test_quoted_values_hide_their_letters(spark):
    assert _inside(spark, '<a title="a>b" href="/1">x</a>') == ["/1"]
    assert _inside(spark, """<a title="see href='x'" href="/y">z</a>""") == ["/y"]
    assert _inside(spark, "<a href\n=\n'/2'>x</a><a/href=/3>x</a>") == ["/2", "/3"]


def test_character_references(spark):
    html = "<a href='/&#225;&#x2F;&eacute;&amp;amp;&nope;&#xD800;&#99999999;&'>x</a>"
    assert _inside(spark, html) == ["/á/é&amp;&nope;&#xD800;&#99999999;&"]


def test_many_links_take_linear_time(spark):
    html = "".join(f"<a href='/{i}'>x</a>" for i in range(32_000))
    start = time.perf_counter()
    assert len(_inside(spark, html)) == 32_000
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize("piece", ["<!-- ", "<script ", "<style>x", "<a ", "<a href='x ", "<a href=", '<"', "&", "<!-- -- "])
def test_broken_pages_take_linear_time(spark, piece):
    """A page of a megabyte that nothing closes; a link before it is found all the same."""
    html = "<div><a href='/1'>x</a>" + piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    assert _inside(spark, html)[:1] == ["/1"]
    assert time.perf_counter() - start < 10


def test_what_is_never_closed_reaches_to_the_end(spark):
    before = "<div><a href='/1'>x</a>"
    for rest in ("<!-- <a href='/2'>x</a>", "<script><a href='/2'>x</a></div>"):
        assert _inside(spark, before + rest) == ["/1"]
    quoted = before + "<p title='<!-- <a href=x>'></p><a href='/3' title=\"</div>\">y</a></div>"
    assert _inside(spark, quoted) == ["/1", "/3"]


def test_pages_are_tokenized_once(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    plan = container_links(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
