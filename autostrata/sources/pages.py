"""Links to data files in crawled pages."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autostrata.functions.filenames import link_file_name

# What follows a tag's name: quoted values may hold any letter. Nothing is tried twice, and what is
# never closed reaches to the page's end, so a page is read in linear time, however broken it is.
_REST = r"(?:[^>\"']++|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"

# What a page is cut into, in order: comments and raw text, which hold no links, and tags.
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(?:script(?=[\s/>]).*?(?:</script\s*>|\z)|style(?=[\s/>]).*?(?:</style\s*>|\z))"
    rf"|</?[a-z]{_REST}"
)

# The highest code point; larger numbers are no character references.
_LAST = 0x10FFFF


def _attributes_before(name: str) -> str:
    """Attributes of a tag, in order, up to the first one called ``name``."""
    value = r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+"
    return rf"(?:[\s/]++(?!{name}[\s=])[^\s\"'<>/=]++{value})*+[\s/]++{name}\s*+=\s*+"


_HREF = rf"(?is)\A<a{_attributes_before('href')}(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def _with_anchors(pages: DataFrame, html: str, tag: str, element_id: str | None) -> DataFrame:
    """``pages`` with their ``_anchors``: the anchor tags inside the first matching container,
    nested elements of its kind included.

    The page is tokenized once. Of its tags those of the container's kind and the anchors stay. They
    are walked in order from the container's opening tag on, counting how many elements of that
    kind are open; the anchors before the tag that closes the container count. Each step is a
    column of its own, so that nothing is computed twice.
    """
    name = re.escape(tag)
    if element_id is None:
        opening = rf"(?is)\A<{name}[\s/>]"
    else:
        wanted = re.escape(element_id)
        opening = (
            rf"(?is)\A<{name}{_attributes_before('id')}"
            rf"(?:\"{wanted}\"|'{wanted}'|{wanted}(?=[\s>]))"
        )
    of_kind = rf"(?is)\A<(?:a|/?{name})(?=[\s/>]).*>\z"
    tags = F.filter(
        F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda piece: piece.rlike(of_kind)
    )
    opens = F.filter(
        F.transform(F.col("_tags"), lambda piece, i: F.when(piece.rlike(opening), i)),
        lambda i: i.isNotNull(),
    )
    # Behind the opening tag; nothing is left of a page without one.
    first = F.coalesce(F.try_element_at("_opens", F.lit(1)) + 2, F.size("_tags") + 1)
    inner = F.slice("_tags", F.col("_first"), F.size("_tags"))
    # Depth before the next tag, number of tags so far, and the number of the closing one.
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(state: Column, piece: Column) -> Column:
        change = (
            F.when(piece.rlike(rf"(?is)\A</{name}[\s/>]"), -1)
            .when(piece.rlike(r"(?s)/\s*>\z"), 0)  # closed by itself
            .when(piece.rlike(rf"(?is)\A<{name}[\s/>]"), 1)
            .otherwise(0)
        )
        depth, at = state["depth"] + change, state["at"] + 1
        closed = (depth == 0) & (state["end"] == 0)
        return F.struct(
            depth.alias("depth"),
            at.alias("at"),
            F.when(closed, at).otherwise(state["end"]).alias("end"),
        )

    end = F.aggregate("_inner", start, step, lambda state: state["end"])
    inside = F.slice("_inner", F.lit(1), F.when(F.col("_end") > 0, F.col("_end")).otherwise(F.size("_inner")))
    return (
        pages.withColumn("_tags", tags)
        .withColumn("_opens", opens)
        .withColumn("_first", first)
        .withColumn("_inner", inner)
        .withColumn("_end", end)
        .withColumn("_anchors", F.filter(inside, lambda piece: piece.rlike(r"(?is)\A<a[\s/>]")))
    )


def _decoded(value: Column) -> Column:
    """The value with its numeric and named character references replaced."""
    # One string that is cut up once, while the query is planned.
    listed = "\x01".join(f"{name}\x02{chr(code)}" for name, code in name2codepoint.items())
    named = F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))
    parts = F.split(value, "&")

    def letter(part: Column) -> Column:
        reference = F.regexp_extract(part, r"\A(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z0-9]+);", 1)
        number = F.when(
            reference.rlike(r"\A#[xX]"), F.conv(F.substr(reference, F.lit(3)), 16, 10)
        ).otherwise(F.when(reference.startswith("#"), F.substr(reference, F.lit(2))))
        code = number.cast("bigint")
        # Halves of surrogate pairs are no characters.
        valid = (code > 0) & (code <= _LAST) & ~code.between(0xD800, 0xDFFF)
        char = F.when(
            valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        ).otherwise(F.try_element_at(named, reference))
        rest = F.substr(part, F.length(reference) + 2)
        return F.when(char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    others = F.transform(F.slice(parts, F.lit(2), F.size(parts)), letter)
    whole = F.concat(F.element_at(parts, 1), F.array_join(others, ""))
    return F.when(F.contains(value, F.lit("&")), whole).otherwise(value)


def _href(anchor: Column) -> Column:
    return _decoded(F.concat(*(F.regexp_extract(anchor, _HREF, i) for i in (1, 2, 3))))


def container_links(
    pages: DataFrame,
    tag: str = "div",
    element_id: str | None = "parent-fieldname-text",
    keyword: str | None = "combustivel",
    html: str = "html",
) -> DataFrame:
    """Links inside one container of each page: its columns but ``html``, ``nr_posicao``, ``href``.

    The container is the first ``tag`` element, with the given id if there is one to look for.
    Links need a non-empty address that contains ``keyword`` in any case; ``nr_posicao`` counts
    them from 0 in page order. A page without the container has no links. Each page is handled
    by itself, so there is no shuffle.
    """
    links = F.filter(F.transform("_anchors", _href), lambda href: href != "")
    if keyword is not None:
        links = F.filter(links, lambda href: F.contains(F.lower(href), F.lit(keyword.lower())))
    others = [c for c in pages.columns if c != html]
    found = _with_anchors(pages, html, tag, element_id)
    return found.select(*others, F.posexplode(links).alias("nr_posicao", "href"))


def linked_files(links: DataFrame) -> DataFrame:
    """Add the local file name of each link as ``nm_file``."""
    return links.withColumn("nm_file", link_file_name(F.col("href"), F.col("nr_posicao")))
