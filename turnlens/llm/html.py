"""Main text of web pages: text-to-tag ratio of lines, smoothed and clustered.

A streaming standard-library parser turns a page into lines, one per block of text, each with
its number of characters, its number of tags and the container it stands in. Menus, forms and
other parts that name themselves as such are marked while parsing; a mark by class or id gives
way to an article inside it if there is no other, and counts for nothing if no line is left. The text-to-tag ratio of
the remaining lines is smoothed with a Gaussian, a threshold splits content from the rest,
and the content lines vote for the container that is the page's article; every unmarked line
of that container is kept, so short paragraphs are not lost to the threshold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "head script style noscript template iframe object svg canvas audio video nav footer aside form button select "
    "textarea dialog menu".split()
)
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 header ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address details summary hgroup fieldset hr".split()
) | SKIPPED
CONTAINERS = frozenset("body main article section div td header blockquote".split())
#: What may stand in a head; anything else ends a head whose end tag is left out.
IN_HEAD = frozenset("head title base link meta style script noscript template basefont bgsound".split())
CLOSES_P = BLOCKS - {"html", "body", "head"}
#: Opening one of these ends an open element of the same set, up to the given parent.
SIBLINGS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "tr": ({"tr"}, {"table"})}

# Words in class and id attributes, and roles, that name a part as not the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert warning popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar aside footer masthead topbar toolbar comment comments respond disqus replies reply related recommended "
    "share sharing social newsletter subscribe signup login register search widget widgets pagination pager skip "
    "copyright legal disclaimer".split()
)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
WORDS = re.compile(r"[a-z]+")


@dataclass
class Line:
    text: str
    tags: int
    path: tuple[int, ...]
    #: 0 unmarked; 1 in an article of a block that only its class or id marks; 2 else in such a block.
    level: int = 0


@dataclass
class Element:
    tag: str
    number: int
    side: bool
    #: A block that only the words of its class or id mark.
    named: bool = False


@dataclass
class Container:
    tag: str
    lines: list[int] = field(default_factory=list)


class Lines(HTMLParser):
    """Parser events to lines; bounded by the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        self.kinds: dict[int, str] = {}
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.side = 0
        self.named = 0
        self.path: tuple[int, ...] = ()

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.path, self.level()))
        self.parts, self.tags = [], 0

    def level(self) -> int:
        if not self.named:
            return 0
        for element in reversed(self.open):
            if element.named:
                return 2
            if element.tag in ("article", "main"):
                return 1
        return 2

    def pop(self, index: int) -> None:
        """Close the open elements from ``index`` on."""
        if any(element.named for element in self.open[index:]):
            self.end_line()
        for element in self.open[index:]:
            self.side -= element.side
            self.named -= element.named
        del self.open[index:]
        self.path = tuple(e.number for e in self.open if e.number)

    def last(self, tags, parents=frozenset()) -> int | None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in tags:
                return i
            if self.open[i].tag in parents:
                return None
        return None

    def handle_starttag(self, tag, attrs) -> None:
        block = tag in BLOCKS
        if tag == "body" and (at := self.last({"head"})) is not None or tag not in IN_HEAD and (at := self.in_head()) is not None:
            self.pop(at)
        if block:
            self.end_line()
            if tag in CLOSES_P and (at := self.last({"p"}, CONTAINERS | {"li", "table"})) is not None:
                self.pop(at)
            if tag in SIBLINGS and (at := self.last(*SIBLINGS[tag])) is not None:
                self.pop(at)
        elif tag == "br":
            self.parts.append(" ")
        if not self.side:
            self.tags += 1
        if tag in VOID:
            return
        side = self.is_side(tag, dict(attrs))
        named = not side and self.is_named(tag, dict(attrs))
        if named and not block:
            side, named = True, False
        number = 0
        if tag in CONTAINERS:
            number = len(self.kinds) + 1
            self.kinds[number] = tag
        self.open.append(Element(tag, number, side, named))
        self.side += side
        self.named += named
        if number:
            self.path = (*self.path, number)

    def is_side(self, tag: str, attrs: dict) -> bool:
        if tag in SKIPPED:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header" and not any(e.tag in ("article", "main") for e in self.open):
            return True
        if not attrs:
            return False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in SIDE_ROLES:
            return True
        return re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I) is not None

    def is_named(self, tag: str, attrs: dict) -> bool:
        """Whether class or id name a part; those of an article count inside a named block only (comments)."""
        if not attrs or tag in ("html", "body", "main") or (tag == "article" and not self.named):
            return False
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        return not SIDE_WORDS.isdisjoint(WORDS.findall(names))

    def in_head(self) -> int | None:
        return len(self.open) - 1 if self.open and self.open[-1].tag == "head" else None

    def handle_endtag(self, tag) -> None:
        if tag in BLOCKS:
            self.end_line()
        at = self.last({tag})
        if at is not None:
            self.pop(at)

    def handle_data(self, data) -> None:
        if (at := self.in_head()) is not None and data.strip():
            self.pop(at)
        if not self.side:
            self.parts.append(data)


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    """Gaussian mean of each line and its neighbours within three sigma."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(reach + 1)]
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(ratios), i + reach + 1)):
            w = weights[abs(i - j)]
            total, weight = total + w * ratios[j], weight + w
        out.append(total / weight)
    return out


def content_lines(lines: list[Line], sigma: float = 1.0) -> list[int]:
    """Lines whose smoothed ratio reaches half a standard deviation below the mean or more."""
    ratios = smoothed([len(x.text) / max(1, x.tags) for x in lines], sigma)
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    return [i for i, r in enumerate(ratios) if r >= mean - spread / 2]


def region(lines: list[Line], kinds: dict[int, str], content: list[int]) -> list[Line]:
    """The lines of the article: the deepest container that holds most of the content text.

    An ``article`` or ``main`` on the way there is taken whole.
    """
    weight: dict[int, int] = {}
    for i in content:
        for number in lines[i].path:
            weight[number] = weight.get(number, 0) + len(lines[i].text)
    total = sum(len(lines[i].text) for i in content)
    best, path = 0, ()
    for i in content:
        for depth, number in enumerate(lines[i].path):
            if 2 * weight[number] > total and depth + 1 > len(path):
                best, path = number, lines[i].path[: depth + 1]
    named = [n for n in path if kinds[n] in ("article", "main")]
    best = named[0] if named else best
    return [x for x in lines if not best or best in x.path]


def unmarked(lines: list[Line], kinds: dict[int, str]) -> list[Line]:
    """The lines that may be the article's.

    A class or id may name what a wrapper has beside the article ("with-sidebar"). So an article
    inside it counts if the page has no other one, and all such blocks do if no line is left.
    """
    free = [x for x in lines if x.level == 0]
    if not any(kinds[n] in ("article", "main") for x in free for n in x.path):
        free = [x for x in lines if x.level < 2]
    return free or lines


def main_text(page: str | None, sigma: float = 1.0) -> str:
    """The article's blocks joined by newlines; empty without any."""
    parser = Lines()
    parser.feed(page or "")
    parser.close()
    parser.end_line()
    if not parser.lines:
        return ""
    lines = unmarked(parser.lines, parser.kinds)
    kept = region(lines, parser.kinds, content_lines(lines, sigma))
    return "\n".join(x.text for x in kept)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sigma: float = 1.0
) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    Null or empty html and pages without text give an empty text. The whole page is parsed,
    whatever its length. Repeated rows give repeated results, an empty table an empty one, and
    other columns are not read. Character references are decoded, white space inside a block
    becomes one space, blocks are trimmed and joined in page order by one newline.
    """

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: main_text(page, sigma))

    texts = pages.select(id_col, url_col, text_of(text_or_empty(html_col)).alias("text"))
    return texts.select(id_col, url_col, "text", F.char_length("text").cast("long").alias("n_chars"))
