"""Main text of web pages by two-pass block rules (after jusText, Pomikalek 2011).

The page is read as a stream of tags and cut into blocks at block-level tags.  Parts
that are never article text by what they are (scripts, styles, menus, page headers
and footers, sidebars, and elements named as adverts, notices or reader comments) give
no blocks, only a border.  So do forms and such parts left open to the end of the page
or article, unless they hold the article or a block that the first pass calls good.

*First pass*: a block's link density, length and stop-word density make it good, bad
or ambiguous.  *Second pass*: ambiguous blocks inherit the label of the nearest decided
neighbour; borders count as bad.  Where the page marks its article (``article``, else
``main``), blocks outside are bad, the borders of the article count as good for the
blocks inside, and a low stop-word density alone leaves a block ambiguous.

At scale: one pass over the pages without a shuffle; the work is a page at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Function words of the languages met, as plain words.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were
der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son
el los las del y por con para una su al lo como más pero sus este ya o fue ha sí porque
""".split())

MAX_LINK_DENSITY = 0.2
SHORT = 70  # characters
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.2

_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
_NEVER = frozenset("""head title script style noscript template iframe object embed svg canvas math audio video map nav footer aside
button select option textarea input label menu dialog""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Names of classes, ids and roles (whole, or up to or from a hyphen or underscore) of parts that are no article text.
_NAMED = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices notification alert popup modal overlay sidebar sidebars complementary menu menus nav navbar navigation
breadcrumb breadcrumbs pagination pager masthead topbar footer contentinfo copyright share sharing social related recommended
newsletter subscribe subscription signup login search comment comments disqus replies respond reactions skip widget widgets""".split())
_IN_HEAD = frozenset("base link meta title script style noscript template object".split())
_TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
_KEEPS_NAME = frozenset("html body main article".split())
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    inside: bool  # of the page's article
    heading: bool
    soft: tuple[int, ...] = ()  # forms and parts left open around it, within the article
    text: list[str] = field(default_factory=list)
    linked: int = 0


def _named_away(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in _KEEPS_NAME:
        return False
    for key, value in attrs:
        if key in ("hidden",) or (key == "aria-hidden" and value == "true"):
            return True
        if key in ("class", "id", "role") and value:
            for name in value.lower().split():
                first, _, rest = name.replace("_", "-").partition("-")
                if first in ("has", "with", "no", "without"):
                    continue
                if name in _NAMED or first in _NAMED or rest.rpartition("-")[2] in _NAMED or (key == "role" and name == "banner"):
                    return True
    return False


class _Blocks(HTMLParser):
    """Blocks of a page; ``None`` stands for a border (an excluded part, an article's edge),
    a number for the edge of a form or of a part that is known to be left open."""

    def __init__(self, article: str | None, known: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.article = article
        self.known, self.left_open = known, set()  # start tags by number
        self.found: list[Block | int | None] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, excluded, number of the start tag
        self.soft: list[int] = []
        self.tags = self.base = 0
        self.away = self.links = self.articles = 0
        self.heading = False

    def _cut(self, border: bool = False):
        if border and (not self.found or self.found[-1] is not None):
            self.found.append(None)
        elif not border and self.found and isinstance(self.found[-1], Block) and self.found[-1].text:
            self.found.append(Block(self.articles > 0, self.heading, tuple(self.soft[self.base:])))

    def _end_head(self, tag: str | None):
        """The head ends at the body, or at the first text or tag that it cannot hold."""
        names = [name for name, _, _ in self.open]
        if "head" in names and (tag == "body" or names[-1] == "head" and tag not in _IN_HEAD):
            self._close(names.index("head"))

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self._end_head(tag)
        if tag == "br":
            self.handle_data(" ")
        if tag in _VOID:
            if tag == "hr":
                self._cut()
            return
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
            self._implied_end(tag)
        away = tag in _NEVER or (tag == "header" and not self.articles) or _named_away(tag, attrs)
        soft = not self.away and (tag == "form" and not away or self.tags in self.known)
        away = away and not soft
        self.open.append((tag, away, self.tags))
        if soft:
            self.soft.append(self.tags)
            self.found.append(self.tags)
        elif away:
            self.away += 1
            self._cut(border=True)
        elif tag == self.article:
            if not self.articles:
                self.base = len(self.soft)
            self.articles += 1
            self._cut(border=True)
        elif tag == "a":
            self.links += 1
        elif tag in _BLOCKS:
            self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            self._cut()

    def _implied_end(self, tag):
        """A paragraph or item that was left open ends where the next one begins."""
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self._close(i)
                return
            if name in _BLOCKS and name not in ("p", "td", "th", "dt", "dd"):
                return

    def _close(self, i, by: str | None = None):
        for name, away, number in reversed(self.open[i:]):
            if away:
                if name in _BLOCKS and by != name and by in ("body", "html", self.article):
                    self.left_open.add(number)
                self.away -= 1
                self._cut(border=True)
            elif number in self.soft:
                self.soft.remove(number)
                self.found.append(number)
            elif name == self.article:
                self.articles -= 1
                if not self.articles:
                    self.base = 0
                self._cut(border=True)
            elif name == "a":
                self.links -= 1
            elif name in _BLOCKS:
                self.heading = False
                self._cut()
        del self.open[i:]

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            name, away, _ = self.open[i]
            if name == tag:
                self._close(i, tag)
                return
            within = name in _BLOCKS and tag in _BLOCKS and (name not in _TABLE or tag in _TABLE)
            if tag not in _BLOCKS and name in _BLOCKS or away and not within and tag not in ("body", "html", self.article):
                return  # an inline end does not close blocks, nor a stray end an excluded part

    def close(self):
        super().close()
        self.left_open.update(number for name, away, number in self.open if away and name in _BLOCKS)

    def handle_data(self, data):
        if self.away and data.strip():
            self._end_head(None)
        if self.away:
            return
        if not self.found or not isinstance(self.found[-1], Block):
            if not data.strip():
                return
            self.found.append(Block(self.articles > 0, self.heading))
        block = self.found[-1]
        if not block.text:
            block.inside, block.heading, block.soft = self.articles > 0, self.heading, tuple(self.soft[self.base:])
        block.text.append(data)
        if self.links:
            block.linked += len(data.strip())


def _label(text: str, block: Block, marked: bool) -> bool | None:
    """First pass: good, bad, or ambiguous (None)."""
    if marked and not block.inside:
        return False
    n = len(text)
    if block.linked > MAX_LINK_DENSITY * n and (not marked or block.linked > 0.5 * n):
        return False
    if not marked and "©" in text and n <= LONG:
        return False
    if n < SHORT or block.heading:
        return None
    words = _WORD.findall(text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= STOP_HIGH and (n > LONG or marked):
        return True
    if density >= STOP_LOW or marked:
        return None
    return False


def main_text(html: str | None) -> str:
    """The page's article: blocks in page order joined by one space, white space inside a
    block made one space; empty if there is none."""
    html = html or ""
    lower = html.lower()
    article = next((t for t in ("article", "main") if re.search(rf"<{t}[\s>]", lower)), None)
    parser = _Blocks(article)
    parser.feed(html)
    parser.close()
    if parser.left_open:
        parser = _Blocks(article, frozenset(parser.left_open))
        parser.feed(html)
        parser.close()
    found = [(b, " ".join("".join(b.text).split()) if isinstance(b, Block) else "") for b in parser.found]
    good = {x for b, t in found if t and b.soft and _label(t, b, False) for x in b.soft}
    blocks, texts = [], []
    for b, t in found:
        if b is None or (b not in good if isinstance(b, int) else t and not good.issuperset(b.soft)):
            blocks.append(None)
            texts.append("")
        elif t:
            blocks.append(b)
            texts.append(t)
    marked = article is not None
    labels = [None if b is None else _label(t, b, marked) for b, t in zip(blocks, texts)]
    edge = [b is None for b in blocks]
    n = len(blocks)
    decided = list(labels)
    # second pass: the nearest decided neighbour on either side, counted in blocks
    before: list[tuple[int, bool]] = []
    now = (-1, marked)
    for i in range(n):
        before.append(now)
        if edge[i]:
            now = (i, marked)
        elif labels[i] is not None:
            now = (i, labels[i])
    now = (n, marked)
    for i in range(n - 1, -1, -1):
        if edge[i]:
            now = (i, marked)
            continue
        if labels[i] is None:
            (a, x), (b, y) = before[i], now
            near, far = (x, y) if i - a < b - i else (y, x)
            decided[i] = near if i - a != b - i else (y if blocks[i].heading else x or y)
        else:
            now = (i, labels[i])
    return " ".join(t for t, keep, e in zip(texts, decided, edge) if keep and not e)


def text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series([main_text(x) for x in s], dtype=object)

    return run(html)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``df``; a null or empty page has
    the empty text; null ids and urls and repeated rows are kept as they are."""
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.select("page_id", "url", text_column(F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
