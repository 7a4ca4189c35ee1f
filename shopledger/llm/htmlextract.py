"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one per block. Each line
has a text-to-tag ratio: its characters over the tags inside it, links counting as tags
that hold no text. The ratios are smoothed with a Gaussian, and a threshold splits the
lines into content and the rest. All content lines are kept, and with them the short lines of
the region: the elements that hold the content lines, and few links. What is furniture by
its element or role goes before, and what is by its name (class, id) and forms, unless they
hold the main article, or most of the text and no link list. So do reader comments under a
heading that says so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch

# Elements without an end tag, elements that start a line, elements that hold others,
# elements that are never content, and names, classes and roles of furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body main article section div header footer nav aside form fieldset ul ol dl table thead tbody tfoot tr figure "
    "details dialog center hgroup search menu".split()
)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre address td th caption figcaption summary hr title legend".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset(
    "head title script style noscript template nav header footer aside button select option textarea iframe object "
    "svg canvas math dialog menu search audio video map".split()
)
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising advertorial adsense banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices notification alert sidebar aside menu menus nav navbar navigation "
    "breadcrumb breadcrumbs comment comments reply replies respond disqus footer header masthead share sharing social "
    "related recommended newsletter subscribe subscription signup popup modal overlay widget widgets toolbar pagination "
    "pager".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CONTENT = frozenset("main article".split())
# Class and id words beside "header" that make it the head of the article, and headings over reader comments.
ARTICLE_WORDS = frozenset("article entry post story".split())
COMMENT_HEADING = re.compile(
    r"(\d+ )?((reader|user|leave a|post a|add a|all|latest) )?"
    r"(comments?|repl(y|ies)|responses?|kommentare?|commentaires?|comentarios?)( \(\d+\))?:?",
    re.I,
)
IN_HEAD = frozenset("base link meta noscript script style template title".split())

SIGMA = 1.0
RADIUS = 3
# The region holds this share of the text of the content lines; what is added to it has this share of text outside links.
REGION_SHARE = 0.9
# An element with this share of the text is not furniture by its name, unless main or article elements elsewhere hold
# so much of the text.
NAMED_SHARE, ELSEWHERE_SHARE = 0.5, 0.2

# Numeric references beyond any character, which the standard library would read as a number of any length.
_LARGE_REFERENCE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_COMMENT_END = re.compile("--!?>")


def _character(reference: re.Match) -> str:
    """A long reference without its leading zeros, or the replacement character."""
    base, digits = ("&#x", reference[0][3:]) if reference[0][2] in "xX" else ("&#", reference[0][2:])
    digits = digits.rstrip(";").lstrip("0")
    return f"{base}{digits};" if 0 < len(digits) < 8 else "\ufffd"


class _Lines(HTMLParser):
    """Lines of a page: ``(element, parts, tags)``, a part being ``(element, text, inside a link)``.

    An element is a number, zero for the page; ``parent`` and ``kinds`` tell the one around it,
    which has a smaller number, and its tag. Named elements are those that are furniture by
    their class or id, if at all, and forms. The page is given as a whole; a comment, declaration or tag that it does not end goes on to its
    end, as in browsers, so nothing is searched for twice.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, list[tuple[int, str, int]], int]] = []
        self.kinds = [""]
        self.parent = [0]
        self.depth = [0]
        self.holder = [0]  # the innermost container that holds an element or is it
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, int] = {}  # open elements by tag
        self.shut: list[int] = []  # places in the stack of open elements that are furniture
        self.names: set[int] = set()
        self.titled: set[int] = set()  # furniture whose headings are the article's
        self.parts: list[tuple[int, str, int]] = []
        self.tags = self.in_link = 0
        self.open_ended: dict[str, bool] = {}
        self.page = ""
        self.last_end = -1

    @property
    def inner(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def read(self, page: str) -> None:
        self.page = _LARGE_REFERENCE.sub(_character, page)
        self.last_end = self.page.rfind(">")
        self.feed(self.page)
        self.close()

    def _after(self, sign: str, i: int) -> int:
        end = self.rawdata.find(sign, i)
        return len(self.rawdata) if end < 0 else end + len(sign)

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        return self._after(">", i)

    def parse_html_declaration(self, i: int) -> int:
        return self._after(">", i)

    def _unfinished(self, i: int) -> bool:
        # ``rawdata`` is what is left of the page.
        return i + len(self.page) - len(self.rawdata) > self.last_end

    def parse_starttag(self, i: int) -> int:
        if self._unfinished(i):
            return len(self.rawdata)
        end = super().parse_starttag(i)
        return end if end >= 0 else self._after(">", i)

    def parse_endtag(self, i: int) -> int:
        if self._unfinished(i):
            return len(self.rawdata)
        end = super().parse_endtag(i)
        return end if end >= 0 else self._after(">", i)

    def flush(self) -> None:
        if any(not text.isspace() for _, text, _ in self.parts):
            self.lines.append((self.inner, self.parts, self.tags))
        self.parts, self.tags = [], 0

    def _furniture(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in NEVER:
            return True
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "hidden":
                return True
            if name == "role" and value and value.lower() in ROLES:
                return True
        return False

    def _names(self, tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
        """The words of an element's class and id."""
        if tag in ("html", "body", "main"):
            return set()
        values = [value.lower() for name, value in attrs if name in ("class", "id") and value]
        return {word for value in values for word in re.split("[^a-z0-9]+", value)}

    def _open_furniture_ends(self) -> None:
        """Furniture that the page does not end is ended by the main article."""
        at = self.shut[0]
        tag = self.stack[at][0]
        if tag not in self.open_ended:
            starts, ends = (len(re.findall(f"<{mark}{tag}[\\s/>]", self.page, re.I)) for mark in ("", "/"))
            self.open_ended[tag] = starts > ends
        if self.open_ended[tag]:
            self._close(at)

    def _end_head(self) -> None:
        """What a head cannot hold ends it, as its end tag may be left out."""
        if self.stack and self.stack[-1][0] == "head":
            self._close(len(self.stack) - 1)

    def _close(self, depth: int) -> None:
        """Closes open elements down to a depth."""
        for tag, _ in self.stack[depth:]:
            self.open[tag] -= 1
        del self.stack[depth:]
        while self.shut and self.shut[-1] >= depth:
            self.shut.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag == "br":
            self.parts.append((self.inner, " ", 0))
        self.tags += 1
        if tag in VOID and tag != "hr":
            return
        if tag == "a":
            self.in_link = 1
        if tag in BLOCKS or tag in NEVER:
            self.flush()
            if tag == "hr":
                return
            self._imply_ends(tag)
            self.tags = 1
            self.in_link = 0
        if self.shut and tag in CONTENT:
            self._open_furniture_ends()
        names = self._names(tag, attrs)
        titled = FURNITURE & names == {"header"} and not ARTICLE_WORDS.isdisjoint(names)
        furniture = titled or self._furniture(tag, attrs)
        named = not furniture and not self.shut and (tag == "form" or not FURNITURE.isdisjoint(names))
        if not (tag in BLOCKS or furniture or named):
            return
        number = len(self.kinds)
        self.kinds.append(tag)
        self.parent.append(self.inner)
        self.depth.append(len(self.stack))
        self.holder.append(number if tag in CONTAINERS else self.holder[self.inner])
        if titled:
            self.titled.add(number)
        if named:
            self.names.add(number)
        if furniture:
            self.shut.append(len(self.stack))
        self.stack.append((tag, number))
        self.open[tag] = self.open.get(tag, 0) + 1

    def _imply_ends(self, tag: str) -> None:
        """A block ends an open paragraph or heading; items and cells end their like."""
        if self.stack and self.stack[-1][0] in ("p", *HEADINGS):
            self._close(len(self.stack) - 1)
        alike = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
        while tag in alike and self.stack and self.stack[-1][0] in alike[tag]:
            self._close(len(self.stack) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # In HTML the slash means nothing, unless the element has no end anyway.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.in_link = 0
        at = len(self.stack) - 1 if self.open.get(tag) else -1
        while at >= 0 and self.stack[at][0] != tag:
            # Only containers end what another container holds.
            if tag not in CONTAINERS and self.stack[at][0] in CONTAINERS:
                return
            at -= 1
        if at < 0:
            if tag in BLOCKS:
                self.flush()
            return
        self.flush()
        self._close(at)

    def handle_data(self, data: str) -> None:
        if self.shut and not data.isspace():
            self._end_head()
        if self.shut and not self._title_of_article():
            return
        self.parts.append((self.inner, data, self.in_link))

    def _title_of_article(self) -> bool:
        """A heading in the header of an article belongs to the article."""
        if len(self.shut) > 1 or self.stack[-1][0] not in HEADINGS:
            return False
        tag, number = self.stack[self.shut[0]]
        return number in self.titled or (tag == "header" and any(self.open.get(t) for t in CONTENT))

    def up(self, totals: list[int]) -> list[int]:
        """Totals of each element's own, with those of the elements inside it."""
        totals = list(totals)
        for number in range(len(totals) - 1, 0, -1):
            totals[self.parent[number]] += totals[number]
        return totals

    def inside(self, chosen: set[int]) -> list[int]:
        """For each element the outermost of the chosen ones that holds it or is it, else zero."""
        found = [0] * len(self.kinds)
        for number in range(1, len(found)):
            found[number] = found[self.parent[number]] or (number if number in chosen else 0)
        return found

    def above(self, number: int) -> set[int]:
        found = set()
        while number := self.parent[number]:
            found.add(number)
        return found

    def close(self) -> None:
        super().close()
        self.flush()


Line = tuple[int, str, int, int]


def _texts(parser: _Lines, gone: set[int]) -> list[Line]:
    """``(element, text, tags, characters inside links)`` of the lines, without the elements that are gone."""
    lines = []
    inside = parser.inside(gone) if gone else []
    for element, parts, tags in parser.lines:
        if gone:
            parts = [part for part in parts if not inside[part[0]]]
        if text := " ".join("".join([data for _, data, _ in parts]).split()):
            lines.append((element, text, tags, sum(len(data) for _, data, linked in parts if linked)))
    return lines


def _chosen(lines: list[Line]) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are content, and which have text of their own."""
    smooth = ratios(lines)
    # A line of nothing but links has no text of its own, whatever stands beside it.
    own = np.array([len(text) > linked for _, text, _, linked in lines])
    return (smooth >= min(smooth.std(), smooth.max())) & own, own


def _named_furniture(parser: _Lines) -> set[int]:
    """The named elements that are furniture.

    One that holds the largest main or article is not, nor one with most of the page's text
    that the ratios do not reject, unless main or article elements elsewhere hold the text.
    """
    lines = _texts(parser, set())
    if not parser.names or not lines:
        return parser.names
    total = sum(len(text) for _, text, _, _ in lines)
    size, weight = [0] * len(parser.kinds), [0] * len(parser.kinds)
    for (element, text, _, _), chosen in zip(lines, _chosen(lines)[0]):
        size[element] += len(text)
        weight[element] += len(text) * bool(chosen)
    size, weight = parser.up(size), parser.up(weight)
    articles = {n for n, kind in enumerate(parser.kinds) if kind in CONTENT and size[n] and n not in parser.names}
    largest = max(sorted(articles), key=lambda n: size[n], default=None)
    holders = parser.above(largest) if largest else set()
    wide = {n for n in parser.names - holders if size[n] >= NAMED_SHARE * total and 2 * weight[n] >= size[n]}
    if wide:
        of_wide, of_article = parser.inside(wide), parser.inside(articles)
        if sum(len(t) for n, t, _, _ in lines if not of_wide[n] and of_article[n]) >= ELSEWHERE_SHARE * total:
            wide = set()
    return parser.names - holders - wide


def _without_comments(parser: _Lines, lines: list[Line]) -> list[Line]:
    """The lines without the containers that a heading over reader comments begins."""
    begun: set[int] = set()
    gone: set[int] = set()
    for element, text, _, _ in lines:
        if parser.kinds[element] in HEADINGS and COMMENT_HEADING.fullmatch(text):
            holder = parser.holder[element]
            if holder and holder not in begun and parser.kinds[holder] not in ("html", "body", "main", "article"):
                gone.add(holder)
        while element and element not in begun:
            begun.add(element)
            element = parser.parent[element]
    inside = parser.inside(gone)
    return [line for line in lines if not inside[line[0]]]


def ratios(lines: list[Line]) -> np.ndarray:
    """Smoothed text-to-tag ratio of each line."""
    raw = np.array([max(0, len(text) - linked) / max(1, tags) for _, text, tags, linked in lines])
    at = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-0.5 * (at / SIGMA) ** 2)
    # Lines beyond either end count as the last line there.
    padded = np.pad(raw, RADIUS, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _region(parser: _Lines, lines: list[Line], content: np.ndarray) -> tuple[set[int], set[int]]:
    """Elements whose lines are kept, and containers around them of which the lines in no further container are kept."""
    kinds = parser.kinds
    weight, size, free = ([0] * len(kinds) for _ in range(3))
    for (element, text, _, linked), chosen in zip(lines, content):
        size[element] += len(text)
        free[element] += max(0, len(text) - linked)
        weight[element] += len(text) * bool(chosen)
    weight, size, free = parser.up(weight), parser.up(size), parser.up(free)
    total = weight[0]
    marked = {n for n, kind in enumerate(kinds) if kind in CONTENT and weight[n]}
    if marked and sum(weight[n] for n in set(parser.inside(marked)) if n) >= 0.5 * total:
        region = marked
    else:
        holders = [n for n, kind in enumerate(kinds) if kind in CONTAINERS and weight[n] and weight[n] >= REGION_SHARE * total]
        region = {max(holders, key=lambda n: parser.depth[n])} if holders else set()
    # Content lines elsewhere bring the short lines around them: the widest element with few links beside the
    # region; or the lines that stand with them around the region.
    inside = parser.inside(region)
    own = [0] * len(kinds)
    for element, _, _, _ in lines:
        own[element] += bool(inside[element])
    around = {n for n, lines_within in enumerate(parser.up(own)) if n and lines_within}
    fit = {n for n, kind in enumerate(kinds) if kind in CONTAINERS and n not in around and free[n] >= REGION_SHARE * size[n]}
    widest = parser.inside(fit)
    beside, direct = set(), set()
    for (element, _, _, _), chosen in zip(lines, content):
        if region and chosen and not inside[element]:
            beside.add(widest[element])
            direct.add(parser.holder[element])
    return region | (beside - {0}), direct & around


def main_text(html: str | None) -> str:
    """The content blocks of a page, one per line; empty if there are none."""
    parser = _Lines()
    parser.read(html or "")
    lines = _without_comments(parser, _texts(parser, _named_furniture(parser)))
    if not lines:
        return ""
    content, own = _chosen(lines)
    region, direct = _region(parser, lines, content)
    inside = parser.inside(region)
    kept = [
        line[1]
        for line, chosen, texts in zip(lines, content, own)
        if chosen or not region or inside[line[0]] or (texts and parser.holder[line[0]] in direct)
    ]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages(page_id, url, html, ...)``.

    Character references are decoded, white space in a block becomes one space, blocks are
    trimmed and joined by a line feed. Null and empty pages, and pages without content, have
    an empty text. Rows stay as they are, repeated ones and null ids too; other columns are
    ignored, whatever their names.
    """

    def work(ids: list, urls: list, pages: list) -> Iterator[dict]:
        texts = [main_text(html.decode("utf-8", "replace")) if html else "" for html in pages]
        urls = [u if u is None else u.decode("utf-8", "replace") for u in urls]
        yield {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return by_batch(chosen, ["page_id", "url", "html"], work, "page_id long, url string, text string, n_chars long")
