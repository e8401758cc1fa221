"""Main text of web pages from the standard library's streaming parser events.

Method: the parser's events cut a page into lines: one per block of text, with the text outside links
and the number of tags met since the line before. Each line's text-to-tag ratio is smoothed over its
neighbours with a Gaussian. Lines form regions: those of one marked article (``article``, ``main``), else those that follow one
another in one container. A region is content if its highest smoothed ratio, times the region's weight, reaches the standard
deviation of the page's weighted ratios (times ``strictness``). All lines of a content region are kept, short ones too.

Weights come from names: 1 as a rule, ``BESIDE`` for what stands outside the articles of a page that marks any, and ``NAMED`` for
blocks whose class, id or role has a word for another part (menus, adverts, notices, comments). So a page's story wins where the
marked article is a teaser. Names never remove inline text, tables, quotes or figures. Elements that are another part by definition
(``nav``, ``aside``, ``form``, ``script``, ...) never become lines; an article tag ends whatever was left open before it.

Scale: a map over pages, one page in memory at a time, in time linear in its length; nothing is shuffled.

Edge cases: null and empty pages give empty text; broken nesting, missing end tags and text outside any
element are read as browsers do, roughly; repeated rows give repeated results; equal ratios are treated
alike; an empty table gives an empty result; other columns pass through unless named like the results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.llm.worker import claim

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
#: Elements that are never part of an article's text.
OTHER = set("nav header footer aside form script style noscript template head title iframe object svg canvas "
            "button select option textarea input dialog menu audio video".split())
#: Words of class, id or role that name such parts.
OTHER_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
                  "navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie "
                  "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
                  "comment comments disqus replies share sharing social related recommended widget toolbar "
                  "pagination pager complementary contentinfo search skip".split())
ARTICLE = {"article", "main"}
#: Names under which even an article element is none, and prefixes of names that tell of another part.
NOT_ARTICLE = set("comment comments reply replies related promo sponsored ad advert teaser".split())
#: Elements whose text stays with its surroundings whatever they are named.
ANY_NAME = INLINE | set("table thead tbody tfoot tr td th caption blockquote pre figure figcaption p".split())
BESIDE, NAMED = 0.25, 0.05
QUALIFIED = ("has-", "with-", "no-", "without-", "has_", "with_", "no_")
CONTAINER = set("article main body div section td th table ul ol dl blockquote details fieldset".split())
WORD = re.compile(r"[a-z]+")
MARKUP = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ/!?")


@dataclass
class Element:
    name: str
    other: bool  # never content
    named: bool  # has a name of another part
    article: bool
    container: bool


class Lines(HTMLParser):
    """Collects (text, characters outside links, tags, region, in an article, in a named part) of every line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool, bool]] = []
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of a name
        self.blocks: list[int] = []  # places of open blocks, and of those that end a search for an implied end
        self.barriers: list[int] = []
        self.parts: list[str] = []
        self.own, self.tags, self.numbers, self.regions = 0, 0, 0, [0]
        self.other = self.named = self.article = self.links = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.own, max(1, self.tags), self.regions[-1], self.article > 0, self.named > 0))
                self.tags = 0
            self.parts, self.own = [], 0

    def begins_region(self, e: Element) -> bool:
        """An article is one region with all its containers; a named block is a region of its own."""
        return e.named or e.article or e.container and not self.article

    def push(self, e: Element) -> None:
        if self.begins_region(e):
            self.numbers += 1
            self.regions.append(self.numbers)
        at = len(self.open)
        self.open.append(e)
        self.places.setdefault(e.name, []).append(at)
        if e.name not in INLINE:
            self.blocks.append(at)
        if e.container or e.other:
            self.barriers.append(at)
        self.other += e.other
        self.named += e.named
        self.article += e.article
        self.links += e.name == "a"

    def pop(self) -> None:
        e = self.open.pop()
        self.places[e.name].pop()
        for held in (self.blocks, self.barriers):
            if held and held[-1] == len(self.open):
                held.pop()
        self.other -= e.other
        self.named -= e.named
        self.article -= e.article
        self.links -= e.name == "a"
        if self.begins_region(e):
            self.regions.pop()

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        names = {w for k, v in attrs if k in ("class", "id", "role") and v for name in v.lower().split()
                 if not name.startswith(QUALIFIED) for w in WORD.findall(name)}
        if tag not in INLINE:
            self.flush()
            if tag in ARTICLE and not names.intersection(NOT_ARTICLE):  # whatever was left open before ends here
                while self.other + self.named and not self.article:
                    self.pop()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
                self.close_implied(tag)
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        named = tag not in ANY_NAME and tag not in ("html", "body") and not names.isdisjoint(
            NOT_ARTICLE if tag in ARTICLE else OTHER_WORDS)
        article = (tag in ARTICLE or ("role", "main") in attrs) and not named
        self.push(Element(tag, tag in OTHER or hidden, named, article, tag in CONTAINER))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_implied(self, tag: str) -> None:
        """``<p>`` ends an open paragraph, ``<li>`` an open item, up to the next container."""
        places = self.places.get(tag)
        if places and (not self.barriers or places[-1] >= self.barriers[-1]):
            self.pop_to(places[-1])

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        places = self.places.get(tag)
        # a stray end of an inline element closes no block
        if places and not (tag in INLINE and self.blocks and self.blocks[-1] > places[-1]):
            self.pop_to(places[-1])

    def handle_data(self, data: str) -> None:
        if not self.other:
            self.parts.append(data)
            if not self.links:
                self.own += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    padded = np.concatenate([np.full(reach, ratios[0]), ratios, np.full(reach, ratios[-1])])
    return np.convolve(padded, kernel, "valid")


def main_text(html: str, sigma: float = 1.0, strictness: float = 0.5) -> str:
    parser = Lines()
    last = html.rfind("<")
    if last > html.rfind(">") and html[last + 1:last + 2] in MARKUP:  # a tag cut off by the page's end is no text
        html = html[:last]
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    ratio = smoothed(np.array([own / tags for _, own, tags, *_ in lines]), sigma)
    article, named = np.array([line[4] for line in lines]), np.array([line[5] for line in lines])
    ratio *= np.where(named, NAMED, 1.0) * np.where(article | ~article.any(), 1.0, BESIDE)
    region = np.array([line[3] for line in lines])
    best = np.zeros(region.max() + 1)
    np.maximum.at(best, region, ratio)
    content = best[region] >= strictness * ratio.std()
    return " ".join(line[0] for line, kept in zip(lines, content) if kept)


def extract(pages: DataFrame, html: str = "html", text: str = "text", sigma: float = 1.0,
            strictness: float = 0.5) -> DataFrame:
    """All columns of ``pages`` but ``html``, with ``text``."""
    keep = [c for c in pages.columns if c not in (html, text)]
    source = pages.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("__html"))
    schema = T.StructType(source.schema.fields[:-1] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("html_text")
        for batch in batches:
            found = [main_text(h.as_py(), sigma, strictness) for h in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(found, pa.string())],
                                             names=[*keep, text])

    return source.mapInArrow(run, schema)
