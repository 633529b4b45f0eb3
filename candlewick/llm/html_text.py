"""Main text of web pages by tree scoring.

A tolerant parser builds the element tree. Every block of text passes points
for its length and commas to its container and, in falling shares, to the
ancestors above; an element's points are discounted by its link density. The
best container, widened to the article that holds it, is kept together with
siblings that score like it; menus, headers, footers, asides, forms, notices,
adverts and reader comments are left out by element, role and class. Whatever it
is named, an element that holds the main element or the longest article stays, as
does a form around the page's own landmarks. A name that is boilerplate only in
part halves the points of what it holds; such an element stays if the best
container lies in it, or if it is all the text of its article. Of several articles
the one whose paragraphs score best is the text (the first of equals). A page of
boilerplate alone has an empty text.

Inside a block white space becomes one blank; blocks are joined by an empty
line. Null or empty pages, and pages without text, give an empty text. Cut-off
pages, unclosed and misnested elements are read as far as they go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import table

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<[a-zA-Z/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# HTML's own element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
UNIT = frozenset("p pre li dd dt td th blockquote figcaption h1 h2 h3 h4 h5 h6 summary caption".split())
# What a start tag closes when it is open inside the nearest holder.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
HOLDER = frozenset("html body div article section main table ul ol dl td th aside nav header footer form".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Elements, roles and class words of boilerplate.
DROPPED = frozenset("nav aside footer button select menu dialog svg template object canvas audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu "
    "menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments commentlist disqus "
    "respond reply replies discussion cookie cookies consent gdpr notice notices notification alert newsletter "
    "subscribe subscription signup login share sharing social related recommended popup modal overlay widget toolbar "
    "pagination pager skip copyright".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
BASE_POINTS = {"article": 25, "main": 20, "section": 5, "div": 5, "pre": 3, "td": 3, "blockquote": 3,
               "address": -3, "ul": -3, "ol": -3, "dl": -3, "form": -3, "th": -5}
LEVELS = 5
# How sure it is that an element is boilerplate: part of a name says so, it is a
# form, its whole name says so, it holds readers' comments, or its kind says so.
PARTLY, FORM, NAMED, READERS, SURE = 1, 2, 3, 4, 5
LANDMARKS = frozenset("nav header footer main article".split())
PARTLY_WEIGHT = 0.5


class Element:
    __slots__ = ("tag", "parent", "dropped", "link", "points", "length", "linked", "doubt", "plain")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, link: bool, doubt: int = 0):
        self.tag, self.parent, self.dropped, self.link = tag, parent, dropped, link
        self.points = 0.0
        self.length = self.linked = self.plain = 0
        self.doubt = doubt

    def up(self) -> Iterator[Element]:
        e = self
        while e is not None:
            yield e
            e = e.parent


def _boilerplate(tag: str, attributes: str, inside: bool) -> int:
    """0 or one of PARTLY to SURE. ``inside``: within an article or main element,
    where an id names boilerplate only if it is nothing but such words: longer
    ones, and those of headings, are made from titles."""
    if tag in DROPPED or tag == "header" and not inside:
        return SURE
    level = FORM if tag == "form" else 0
    if "=" not in attributes and "hidden" not in attributes or tag in ("html", "body", "main"):
        return level
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            for c in value.split():
                parts = {x for x in re.split(r"[_-]+", c) if x and not x.isdigit()}
                if re.match(r"(?:has|no|with|is)(?:[_-]|$)", c) or name == "id" and tag in HEADINGS:
                    continue
                if parts and parts <= COMMENTS and tag not in HEADINGS:
                    level = max(level, READERS)
                elif parts and parts <= CLASSES or c == "header" and not inside:
                    level = max(level, NAMED)
                elif name == "id" and inside or tag == "article":
                    continue
                elif parts & CLASSES or "header" in parts and not inside:
                    level = max(level, PARTLY)
        elif name == "aria-hidden" and value == "true":
            return SURE
        elif name == "role" and value in ROLES:
            level = max(level, FORM if value == "form" else NAMED)
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes.lower()):
        return SURE
    return level


def _leave_out(elements: list[Element]) -> set[Element]:
    """Mark the elements that are left out for their names, with all inside.
    Whatever it is named, an element that holds the page's main element or its
    longest article stays, and so does a form around the page's own landmarks.
    Returns the elements that stay so."""
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.plain += e.plain
    whole = [e for e in elements if e.tag == "main" and not e.dropped]
    articles = [e for e in elements if e.tag == "article" and not e.dropped and e.doubt < NAMED
                and not any(x.doubt == READERS for x in e.up())]
    if articles:
        whole.append(max(articles, key=lambda e: e.plain))
    holders = {x for e in whole for x in e.up()}
    holders |= {x for e in elements if e.tag in LANDMARKS for x in e.up() if x.doubt == FORM}
    for e in elements:
        if e.parent is not None and e.parent.dropped or e.doubt >= FORM and e not in holders:
            e.dropped = True
    return holders


def _join(read: list[tuple[Element, list[tuple[Element, str]]]], stays) -> list[tuple[Element, str, int]]:
    out = []
    for holder, pieces in read:
        pieces = [(e, s) for e, s in pieces if stays(e)]
        if t := " ".join("".join(s for _, s in pieces).split()):
            out.append((holder, t, min(sum(len(s.strip()) for e, s in pieces if e.link), len(t))))
    return out


def _read(html: str) -> tuple[list[tuple[Element, list[tuple[Element, str]]]], list[Element]]:
    """Per block the element that holds it and its pieces of text with the
    elements they stand in, but for what is surely boilerplate. And all elements."""
    out: list[tuple[Element, list[tuple[Element, str]]]] = []
    root = now = Element("#page", None, False, False)
    elements = [root]
    opened: dict[str, int] = {}
    text: list[tuple[Element, str]] = []
    articles = 0  # open article and main elements

    def flush() -> None:
        if text:
            holder = next(e for e in now.up() if e.tag in BLOCK or e is root)
            out.append((holder, text.copy()))
            text.clear()

    def add(s: str) -> None:
        if s and not now.dropped:
            s = unescape(s) if "&" in s else s
            text.append((now, s))
            if not now.link:
                now.plain += len(s.strip())

    def close(e: Element) -> None:
        """Leave the open elements up to and with e."""
        nonlocal now, articles
        while True:
            if now.tag in BLOCK:
                flush()
            articles -= now.tag in ("article", "main")
            opened[now.tag] -= 1
            gone, now = now, now.parent
            if gone is e:
                return

    at = 0
    search = TAG.search
    while m := search(html, at):
        add(html[at:m.start()])
        at = m.end()
        if end := m[1]:
            tag = end.lower()
            e = now if opened.get(tag) else root
            while e.parent is not None and e.tag != tag:
                if e.tag in HOLDER and tag not in BLOCK:
                    e = root  # an inline end tag does not leave its container
                    break
                e = e.parent
            if e.parent is not None:
                close(e)
            elif tag == "br":
                add(" ")
        elif m[2]:
            tag, attributes = m[2].lower(), m[3]
            if tag in RAW:
                stop = re.compile(f"</{tag}", re.I).search(html, at)
                at = stop.start() if stop else len(html)
                if not stop:
                    break
                at = html.find(">", at) + 1 or len(html)
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    add(" ")
                continue
            if tag in BLOCK:
                # An open paragraph ends where a block starts.
                closes = ("p", *CLOSES.get(tag, ()))
                e, last = now, None
                while e.parent is not None and (e.tag not in HOLDER or e.tag in closes):
                    if e.tag in closes:
                        last = e
                    e = e.parent
                if last is not None:
                    close(last)
                flush()
            doubt = _boilerplate(tag, attributes, articles > 0)
            now = Element(tag, now, now.dropped or doubt == SURE, now.link or tag == "a", doubt % SURE)
            elements.append(now)
            opened[tag] = opened.get(tag, 0) + 1
            articles += tag in ("article", "main")
            if attributes.endswith("/") and tag == "svg":
                close(now)
    add(html[at:])
    flush()
    return out, elements


def _points(t: str, linked: int) -> float:
    """What a block is worth: length and commas, less for links."""
    return (1 - linked / len(t)) * ((len(t) >= 25) + t.count(",") + min(len(t) / 100, 3.0))


def _rate(found: list[tuple[Element, str, int]], elements: list[Element], holders: set[Element]) -> dict[Element, float]:
    """Lengths and points of all elements; the scores of those with text that
    may be a container."""
    for e in elements:
        e.points, e.length, e.linked = 0.0, 0, 0
    for e, t, linked in found:
        e.length += len(t)
        e.linked += linked
        share = _points(t, linked)
        if any(x.doubt == PARTLY and x not in holders for x in e.up()):
            share *= PARTLY_WEIGHT
        x = e.parent if e.tag in UNIT and e.parent is not None else e
        for level in range(LEVELS):
            if x is None:
                break
            x.points += share / (1, 2, 6, 9, 12)[level]
            x = x.parent
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.length += e.length
            e.parent.linked += e.linked

    def score(e: Element) -> float:
        points = e.points + (BASE_POINTS.get(e.tag, 0) if e.points > 0 else 0)
        return points * (1 - e.linked / e.length)

    return {e: score(e) for e in elements if e.length and (e.tag not in UNIT or e.tag in ("td", "blockquote", "pre"))}


def _leave_out_partly(best: Element, found: list[tuple[Element, str, int]], elements: list[Element],
                      holders: set[Element]) -> None:
    """Leave out the elements that are boilerplate by part of their name and do not
    hold ``best``. In an article or main element with no paragraph beside them
    they are the text itself, and stay."""
    around = set(best.up()) | holders

    def named(e: Element) -> Element | None:
        return next((x for x in e.up() if x.doubt == PARTLY and x not in around), None)

    if best.tag in ("article", "main"):
        own = [e for e, t, linked in found if best in e.up() and e.tag not in HEADINGS and _points(t, linked) > 0.5]
        if own and all(named(e) for e in own):
            around |= {x for e in own for x in e.up()}
    for e in elements:
        if e.parent is not None and e.parent.dropped or e.doubt == PARTLY and e not in around:
            e.dropped = True


def main_text(html: str | None) -> str:
    """The page's main text."""
    read, elements = _read(html or "")
    holders = _leave_out(elements)
    found = _join(read, lambda e: not e.dropped)
    if not found:
        return ""
    scores = _rate(found, elements, holders)
    best = max(scores, key=scores.get)
    for tag in ("article", "main"):
        if holder := next((e for e in best.up() if e.tag == tag), None):
            best = holder
            break
    _leave_out_partly(best, found, elements, holders)
    found = _join(read, lambda e: not e.dropped)
    scores = _rate(found, elements, holders)
    order = [e for e in elements if e.length]
    top = max((v for e, v in scores.items() if best in e.up()), default=0)
    kept = {best}
    if best.tag not in ("article", "main") and best.parent is not None:
        # Siblings that read like the text: headings, high scores, long plain paragraphs.
        for e in order:
            if e.parent is best.parent and e is not best:
                plain = e.linked / e.length < 0.25
                if plain and (scores.get(e, 0) >= 0.2 * top or e.length > 80 or e.tag in ("h1", "h2", "h3")
                              or e.tag in UNIT and not e.linked):
                    kept.add(e)
    for e in order:
        if e.parent in kept:
            kept.add(e)
    return "\n\n".join(t for e, t, _ in found if e in kept)


@F.arrow_udf(T.StringType())
def _main_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([main_text(h.as_py()) for h in batch], pa.string())


def extract(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of every page; a column of that name is replaced."""
    return df.withColumn(out, F.coalesce(_main_texts(F.coalesce(F.col(html), F.lit(""))), F.lit("")))


def op2_tree_scoring(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    p = extract(table(spark, sf_dir, "pages"))
    return p.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
