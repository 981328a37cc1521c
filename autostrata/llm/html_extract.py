"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is content or not. The two-valued variables of parent and child are tied by a
potential; tag, names, links and length of an element are its evidence. Sum-product messages, up
from the leaves and down from the root, give each element's probability of being content.
"""

from __future__ import annotations

import html as html_module
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autostrata.llm.common import whole, with_row_key

# Bound of the labelled pages that the model is trained on, and how often a name must occur there.
TRAINING_PAGES = 4_000
LEAST_COUNT = 3

# Elements of HTML by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr frame keygen".split()
)
UNSEEN = frozenset(
    "script style noscript template iframe object svg math canvas audio video head title button "
    "select option optgroup textarea datalist noembed noframes".split()
)
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
LABELLED = frozenset(["article", "main"])

# Tags that bar a block unless it holds the declared main part.
BARRED_TAGS = frozenset("nav footer aside form".split())
# Tags and names that speak against a block, and names that speak for it, before any page is seen.
ASIDE_TAGS = frozenset("menu dialog fieldset search".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disclaimer footer form header login menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted related respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
MAIN_NAMES = frozenset("article content entry main post story".split())
# Parts of names that tell of a frame around other blocks, as in with-sidebar.
FRAME_NAMES = frozenset("container has inner layout no outer page with wrap wrapper".split())
MAIN_PRIOR = 20.0
# Log-odds of a block that is set aside, of what is below one, and of one around the main part.
ASIDE_WEIGHTS = {"aside": -12.0, "below": -8.0, "holds": -3.0}
# Elements whose names say nothing.
FRAMES = frozenset(["html", "body", "article", "main"])
# Bounds of what pages can teach: the most one piece of evidence weighs, and the ties' chances.
MOST_WEIGHT = 3.0
TIES = (0.002, 0.98)

# Which open elements a start tag closes, and which elements stop the search for them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
_P_STOPS = frozenset("td th caption button table html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_UNENDED = re.compile(r"<!--.*\Z", re.DOTALL)
_NAMES = re.compile(
    r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")


class Block:
    """A block element: place of its parent, tag, names, and sums over its text and below.

    ``level`` says how much its names or tag speak against it: 1 for a part of a name beside others
    that speak for content or for a frame (post-header), 2 for another part, 3 for a header, 4 for
    a name that begins with such a part, or a tag of ``ASIDE_TAGS``.
    """

    __slots__ = ("parent", "tag", "names", "level", "chars", "linked")

    def __init__(self, parent: int, tag: str, names: frozenset[str], level: int = 0):
        self.parent, self.tag, self.names = parent, tag, names
        self.level = 0 if tag in ("html", "body") else 4 if tag in ASIDE_TAGS else level
        if tag == "header":
            self.level = 1 if names & MAIN_NAMES else max(level, 3)
        self.chars = self.linked = 0

    def evidence(self, named: bool = True) -> list[str]:
        links = self.linked / self.chars if self.chars else -1
        share = "none" if links < 0 else "low" if links < 0.3 else "mid" if links < 0.7 else "high"
        return [
            f"tag {self.tag}",
            f"tag {self.tag} links {share}",
            f"links {share}",
            f"size {min(self.chars.bit_length(), 12)}",
            *(f"name {n}" for n in self.names if named and self.tag not in FRAMES),
        ]


def _names(attributes: str) -> tuple[frozenset[str], int]:
    """The parts of an element's names, and the level of the name that speaks most against it."""
    if not attributes or attributes.isspace():
        return frozenset(), 0
    found, level = set(), 0
    for _, *values in _NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            parts = [w for w in _NAME_PART.findall(name) if w.isalpha()]
            found.update(parts)
            if not ASIDE_NAMES.isdisjoint(parts):
                if not (MAIN_NAMES | FRAME_NAMES).isdisjoint(parts):
                    level = max(level, 1)
                elif parts[0] == "header":
                    level = max(level, 3)
                else:
                    level = max(level, 4 if parts[0] in ASIDE_NAMES else 2)
    return frozenset(found), level


@dataclass(frozen=True)
class Places:
    """What the tags of a page say of each block.

    ``inside``: in the declared main part; ``holds``: around it or its outermost element, so that
    names do not count; ``barred``: in a block of
    ``BARRED_TAGS`` that is not around it; ``aside``: set aside by names or tag; ``below``: in a
    block that is set aside.
    """

    declared: bool
    inside: list[bool]
    holds: list[bool]
    barred: list[bool]
    aside: list[bool]
    below: list[bool]


def places(blocks: list[Block]) -> Places:
    """The declared main part are the outermost <article> and <main> elements with the fewest
    barring tags around them; articles in a <main> count too, unless names set them aside."""
    n = len(blocks)
    bars, outer, clear = [0] * n, [""] * n, [True] * n
    found, nested = [], []
    for i, b in enumerate(blocks):
        if i:
            up = b.parent
            bars[i] = bars[up] + (b.tag in BARRED_TAGS)
            outer[i], clear[i] = outer[up], clear[up]
        if b.tag in LABELLED:
            if not outer[i]:
                found.append(i)
            elif outer[i] == "main" and clear[i] and ASIDE_NAMES.isdisjoint(b.names):
                nested.append(i)
            outer[i] = b.tag if outer[i] in ("", "main") else outer[i]
        elif outer[i] and b.level >= 4:
            clear[i] = False
    least = min((bars[i] for i in found), default=0)
    declared = {i for i in found if bars[i] == least}
    inside = [False] * n
    for i in range(n):
        inside[i] = i in declared or (i > 0 and inside[blocks[i].parent])
    holds = [False] * n
    for up in (*declared, *(i for i in nested if inside[i] and bars[i] == least)):
        while up >= 0 and not holds[up]:
            holds[up] = True
            up = blocks[up].parent
    barred, aside, below = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        b, up = blocks[i], blocks[i].parent
        barred[i] = barred[up] or (b.tag in BARRED_TAGS and not holds[i])
        # The more the page says of where its main part is, the less a name has to.
        least_level = 4 if inside[i] else 2 if declared else 3
        aside[i] = b.level >= least_level and not holds[i]
        below[i] = below[up] or aside[up]
    return Places(bool(declared), inside, holds, barred, aside, below)


class _Open:
    """The open elements of a page, with the places of each tag's among them, so that looking for
    one takes no walk over the others."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []  # tag, and the block the element belongs to
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str, block: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, block))

    def cut(self, keep: int) -> list[str]:
        """Close all elements from place ``keep`` on; their tags."""
        closed = [tag for tag, _ in self.stack[keep:]]
        for tag in closed:
            self.at[tag].pop()
        del self.stack[keep:]
        return closed

    def last(self, tags: Iterable[str]) -> int:
        """The place of the last open element with one of the tags, -1 without one."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def first_after(self, tags: Iterable[str], place: int) -> int | None:
        """The first place behind ``place`` of an element with one of the tags."""
        found = []
        for t in tags:
            places = self.at.get(t, [])
            i = bisect_right(places, place)
            if i < len(places):
                found.append(places[i])
        return min(found, default=None)


def parse(page: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """The block elements of a page, parents first, and its lines of text with their block.

    The first block stands for the page. Comments, scripts, styles and other elements without
    visible text are skipped. Elements left open are closed as browsers do; a line break is white
    space. Takes time in proportion to the page, however broken it is.
    """
    blocks = [Block(-1, "html", frozenset())]
    lines: list[tuple[int, str]] = []
    elements = _Open()
    parts: list[str] = []
    links = 0
    unended: set[str] = set()  # tags of which the rest of the page ends none

    def flush() -> None:
        line = " ".join("".join(parts).split()) if parts else ""
        if line:
            lines.append((current, line))
        parts.clear()

    def add(text: str) -> None:
        text = html_module.unescape(text) if "&" in text else text
        parts.append(text)
        size = len(text) - text.count(" ")
        blocks[current].chars += size
        blocks[current].linked += size if links else 0

    def close(keep: int) -> None:
        nonlocal current, links
        closed = elements.cut(keep)
        if any(tag in BLOCKS for tag in closed):
            flush()
        links -= closed.count("a")
        current = elements.stack[-1][1] if elements.stack else 0

    current, at, end = 0, 0, len(page)
    last_mark = page.rfind(">")
    while at < end:
        # No tag ends behind the last mark; what looks like one there is text, but for a comment.
        token = _TOKEN.search(page, at) if at <= last_mark else _UNENDED.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if token.re is _UNENDED:
            continue
        tag = (token.group(2) or token.group(5) or "").lower()
        if not tag:
            continue
        attributes = token.group(3) or token.group(6) or ""
        if token.group(1) or token.group(4):
            place = elements.last((tag,))
            if place >= 0:
                close(place)
            continue
        if tag in RAW or tag in UNSEEN:
            if not attributes.endswith("/"):
                stop = None
                if tag not in unended:
                    stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
                if stop:
                    at = page.find(">", stop.start())
                    at = end if at < 0 else at + 1
                else:
                    unended.add(tag)
                    at = end if tag in RAW else at
            continue
        if tag == "br":
            parts.append(" ")
        if tag == "hr":
            flush()
        if tag in VOID:
            continue
        if tag in BLOCKS:
            paragraph = elements.last(("p",))  # which a block ends
            if paragraph > elements.last(_P_STOPS):
                close(paragraph)
        if tag in _CLOSES:
            closed, stops = _CLOSES[tag]
            place = elements.first_after(closed, elements.last(stops))
            if place is not None:
                close(place)
        if tag in BLOCKS:
            flush()
            blocks.append(Block(current, tag, *_names(attributes)))
            current = len(blocks) - 1
        links += tag == "a"
        elements.push(tag, current)
    flush()
    for i in range(len(blocks) - 1, 0, -1):
        above = blocks[blocks[i].parent]
        above.chars += blocks[i].chars
        above.linked += blocks[i].linked
    return blocks, lines


def labels(blocks: list[Block]) -> list[int | None] | None:
    """1 for the blocks in a page's declared main part, 0 for those outside of it or in navigation
    and the like, None for what names speak against in the main part: the page does not tell.
    None for a page that declares no main part."""
    at = places(blocks)
    if not at.declared:
        return None
    out: list[int | None] = []
    for i, b in enumerate(blocks):
        if at.barred[i] or not at.inside[i]:
            out.append(0)
        elif i and at.inside[b.parent] and out[b.parent] is None:
            out.append(None)
        else:
            out.append(None if b.level and not at.holds[i] else 1)
    return out


@dataclass(frozen=True)
class TreeModel:
    """``evidence``: log-odds of a block being content by what is seen of it; ``ties``: chances
    that a child is content, for a parent that is not and for one that is."""

    evidence: dict[str, float]
    ties: tuple[float, float]

    def marginals(self, blocks: list[Block]) -> list[float]:
        """The probability of each block being content, by sum-product over the tree.

        Messages are log-odds. A barred block is no content under either kind of parent, so it
        tells its parent nothing. Names are evidence like any other, which messages can overrule;
        a block around the declared main part is not judged by its names.
        """
        known, (p0, p1) = self.evidence, self.ties
        q0, q1 = 1 - p0, 1 - p1
        n = len(blocks)
        belief = [_PAGE] + [0.0] * (n - 1)
        at = places(blocks)
        barred = at.barred
        for i in range(1, n):
            if barred[i]:
                belief[i] = -_LIMIT
                continue
            seen = blocks[i].evidence(not at.holds[i])
            if at.holds[i] and not at.inside[i]:
                seen.append("holds")
            if at.aside[i]:
                seen.append("aside")
            if at.below[i]:
                seen.append("below")
            belief[i] = sum(known.get(e, 0.0) for e in seen)
        up = [0.0] * n
        for i in range(n - 1, 0, -1):  # children come after their parents
            if barred[i]:
                continue
            odds = exp(_bounded(belief[i]))
            up[i] = log((p1 * odds + q1) / (p0 * odds + q0))
            belief[blocks[i].parent] += up[i]
        for i in range(1, n):
            if barred[i]:
                continue
            without = belief[blocks[i].parent] - up[i]
            odds = exp(_bounded(without))
            belief[i] += log((p1 * odds + p0) / (q1 * odds + q0))
        return [1 / (1 + exp(-_bounded(b))) for b in belief]


_LIMIT = 40.0
_PAGE = -3.0  # log-odds of text outside of all blocks being content


def _bounded(x: float) -> float:
    return min(max(x, -_LIMIT), _LIMIT)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for value in batch.column(0):
            blocks, _ = parse(value.as_py())
            truth = labels(blocks)
            if truth is None:
                continue
            holds = places(blocks).holds
            for i, (b, x) in enumerate(zip(blocks, truth)):
                if i == 0 or x is None:
                    continue
                if truth[b.parent] is not None:
                    found[f"tie {truth[b.parent]}", x] += 1
                # What is around the main part is not outside of it.
                if holds[i] and b.tag not in FRAMES:
                    continue
                found["all", x] += 1
                # A tag counts together with its links: a list in a menu says little of others.
                for e in b.evidence()[1:]:
                    found[e, x] += 1
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys], pa.string()),
                pa.array([x for _, x in keys], pa.int32()),
                pa.array([found[k] for k in keys], pa.int64()),
            ],
            ["seen", "content", "n"],
        )


def fit(pages: DataFrame, html: str = "html", bound: int = TRAINING_PAGES) -> TreeModel:
    """Count potentials on at most ``bound`` pages, chosen by hash, that declare their main part.

    Of equal pages one counts. The pages are chosen by their hashes and read where they are, so no
    page is sent anywhere.

    Spark adds up how often each piece of evidence goes with content, and how often a child is
    content under either kind of parent; what occurs fewer than ``LEAST_COUNT`` times is left out,
    so the driver gets as many rows as there are tags and recurring names. A few names have a
    prior count. Without any labelled page the priors alone decide.
    """
    keyed, key = with_row_key(pages.select(F.lit(0).alias("_id"), html), "_id")
    declaring = keyed.where(F.col(html).rlike(r"(?i)<(?:article|main)[\s/>]"))
    chosen = (
        declaring.groupBy(F.xxhash64(html).alias("_hash"))
        .agg(F.min(key).alias(key))
        .orderBy("_hash")
        .limit(bound)
        .select(key)
    )
    # At most ``bound`` short rows.
    sample = keyed.join(F.broadcast(chosen), key, "left_semi").select(F.col(html).alias("html"))
    counts = (
        sample.mapInArrow(_counts, "seen string, content int, n bigint")
        .groupBy("seen")
        .agg(
            F.sum(F.when(F.col("content") == 0, F.col("n")).otherwise(0)).alias("outside"),
            F.sum(F.when(F.col("content") == 1, F.col("n")).otherwise(0)).alias("inside"),
        )
        .where(F.col("outside") + F.col("inside") >= LEAST_COUNT)
    )
    return _model({r["seen"]: (r["outside"], r["inside"]) for r in counts.collect()})


def _model(counts: dict[str, tuple[int, int]]) -> TreeModel:
    prior: dict[str, tuple[float, float]] = {}
    prior |= {f"tag {t}": (0, MAIN_PRIOR) for t in LABELLED}
    prior |= {f"name {n}": (0, MAIN_PRIOR) for n in MAIN_NAMES}
    prior |= {f"name {n}": (MAIN_PRIOR, 0) for n in ASIDE_NAMES}
    for tag in ("p", "h1", "h2", "h3", "blockquote", "pre"):
        prior[f"tag {tag}"] = (1, 2)
    prior["links high"], prior["links low"] = (2, 1), (1, 2)
    outside, inside = counts.get("all", (0, 0))
    evidence = dict(ASIDE_WEIGHTS)
    for seen in prior.keys() | counts.keys():
        if seen == "all" or seen.startswith("tie "):
            continue
        a, b = counts.get(seen, (0, 0))
        more_a, more_b = prior.get(seen, (0, 0))
        a, b = a + more_a + 0.5, b + more_b + 0.5
        weight = log(b) - log(a)
        weight = weight + log1p(outside) - log1p(inside)
        evidence[seen] = min(max(weight, -MOST_WEIGHT), MOST_WEIGHT)
    ties = []
    for parent, guess in ((0, 0.1), (1, 0.95)):
        a, b = counts.get(f"tie {parent}", (0, 0))
        ties.append(min(max((b + 2 * guess) / (a + b + 2), TIES[0]), TIES[1]))
    return TreeModel(evidence, (ties[0], ties[1]))


def main_text(page: str, model: TreeModel) -> str:
    """The lines of the blocks that are content more likely than not, joined by newlines."""
    blocks, lines = parse(page)
    chances = model.marginals(blocks)
    return "\n".join(line for block, line in lines if chances[block] >= 0.5)


def extract(pages: DataFrame, model: TreeModel, html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with a column ``name``: the main text of the whole page.

    NULL and empty pages, and pages without content, give the empty text. ``name`` takes the place
    of a column of that name.
    """

    @F.pandas_udf("string")
    def extracted(values):
        return values.map(lambda page: main_text(page, model))

    return pages.withColumn(name, extracted(whole(html)))
