"""Main text of web pages by block rules in two passes.

A page is cut into blocks. Elements that never hold an article (menus, forms, scripts and the like, and boxes whose
class or id says advert, cookie notice, comments, ...) give bad blocks. A name that tells of a state of the page
(``comments-open``, ``no-sidebar``) says nothing. The first pass judges the others by
themselves: blocks that are mostly links are bad, blocks with enough stop words for their length are good, and the
rest, short or without stop words, is open. In a box named for controls (share, search, ...) a block is bad unless it is
twice as long, with half as many links, as a good block elsewhere. In the second pass an open block takes the label of the nearest decided
block of the same region (the article it lies in, or else the page): the same label on both sides, or the nearer one,
good if they are equally near. A box inside an article says nothing about its neighbours. With no decided block in
the region, an article is good and anything else is bad.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one.

Defined cases: null and empty pages, and pages without text, give an empty text. Markup that is never closed ends
with the page, except that the first article ends a box it opens in. Equal pages give equal texts. Pages are read whole.
An empty table gives an empty result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.quality import STOP_WORDS
from loadtrail.llm.staging import on_workers

ALL_STOP_WORDS = frozenset(w for own in STOP_WORDS.values() for w in own)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|title|object|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
LETTERS = re.compile(r"[^\W\d_]+")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
REGION_TAGS = frozenset(["article", "main"])
BAD_TAGS = frozenset("nav footer aside form menu dialog button label input header head".split())
#: Parts of class names, ids and roles of boxes that are not the article.
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription signup login social share sharing sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies respond disqus related recommended "
    "widget search pagination pager toolbar skip masthead topbar copyright legal disclaimer".split()
)
#: Of these, names of boxes with controls, in which prose is the article.
CONTROL_NAMES = frozenset("share sharing social search toolbar skip pager pagination".split())
#: Beside one of the names, these make it a state of the page.
STATE_WORDS = frozenset("open closed enabled disabled allowed has no not with without".split())
#: Rules of the first pass: most link characters, characters of a long block, least share of stop words.
MOST_LINKS = 0.5
LONG = 70
LEAST_STOP = 0.15
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())


@dataclass
class Block:
    text: str
    linked: int
    region: int
    in_article: bool
    label: str


def named(attributes: str) -> str | None:
    """What the names of a box say: ``bad``, ``controls`` or nothing."""
    said = None
    for name in " ".join(value.strip("\"'") for value in NAMED.findall(attributes)).lower().split():
        words = set(re.split(r"[^a-z0-9]+", name))
        if words & STATE_WORDS:
            continue
        if words & (BAD_NAMES - CONTROL_NAMES):
            return "bad"
        if words & CONTROL_NAMES:
            said = "controls"
    return said


def blocks(page: str) -> list[Block]:
    """The blocks in page order; those of bad elements are labelled, the others open."""
    found: list[Block] = []
    texts: list[str] = []
    linked: list[str] = []
    regions, made = [0], 0
    bad, depth, links = None, 0, 0
    controls, inner = None, 0

    def close() -> None:
        text = " ".join(html.unescape("".join(texts)).split())
        if text:
            chars = len(" ".join(html.unescape("".join(linked)).split()))
            found.append(Block(text, chars, regions[-1], len(regions) > 1, "bad" if bad else "controls" if controls else "open"))
        texts.clear()
        linked.clear()

    def add(text: str) -> None:
        if text:
            texts.append(text)
            if links:
                linked.append(text)

    at = 0
    for mark in MARKUP.finditer(page):
        add(page[at : mark.start()])
        at = mark.end()
        name = (mark[3] or mark[6] or "").lower()
        if not name:
            if mark[1] and mark[1].lower() == "title":
                close()
            continue
        closing = bool(mark[2] or mark[5])
        attributes = mark[4] or mark[7] or ""
        if name == "br":
            add(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name in BLOCK_TAGS or name in BAD_TAGS:
            close()
        if name in VOID_TAGS or attributes.endswith("/"):
            continue
        if name in REGION_TAGS and not closing and not (made and bad) and named(attributes) != "bad":
            bad, depth = None, 0  # the first article ends a box that was never closed
            controls = controls if made else None
            made += 1
            regions.append(made)
            links = 0
        elif name in REGION_TAGS and closing and not bad and len(regions) > 1:
            regions.pop()
            links = 0
        outside = not bad
        if bad:
            if name == bad:
                depth += -1 if closing else 1
                if depth <= 0:
                    close()
                    bad = None
        elif not closing and name not in ("html", "body") and not (name == "header" and len(regions) > 1):
            said = named(attributes) if attributes else None
            if name in BAD_TAGS or said == "bad":
                close()
                bad, depth = name, 1
            elif said and not controls and name not in REGION_TAGS:
                close()
                controls, inner = name, 0
        if controls and outside and not bad and name == controls:
            inner += -1 if closing else 1
            if inner <= 0:
                close()
                controls = None
    add(page[at:])
    close()
    return found


def judged(block: Block) -> str:
    """First pass: a block by itself."""
    if block.label == "bad":
        return "bad"
    strict = 2 if block.label == "controls" else 1
    if block.linked * strict > MOST_LINKS * len(block.text):
        return "bad"
    words = LETTERS.findall(block.text.lower())
    stops = sum(w in ALL_STOP_WORDS for w in words)
    if len(block.text) >= LONG * strict and stops >= LEAST_STOP * len(words) > 0:
        return "good"
    return "bad" if block.label == "controls" else "open"


def settled(page_blocks: list[Block]) -> list[str]:
    """Second pass: open blocks take the label of their neighbours."""
    labels = [judged(b) for b in page_blocks]
    by_region: dict[int, list[int]] = {}
    for k, block in enumerate(page_blocks):
        by_region.setdefault(block.region, []).append(k)
    out = list(labels)
    for members in by_region.values():
        decided = [labels[k] != "open" and not (page_blocks[k].in_article and page_blocks[k].label in ("bad", "controls") and labels[k] == "bad") for k in members]
        before, last = [], None
        for place, k in enumerate(members):
            before.append(last)
            last = place if decided[place] else last
        after, last = [None] * len(members), None
        for place in range(len(members) - 1, -1, -1):
            after[place] = last
            last = place if decided[place] else last
        for place, k in enumerate(members):
            if labels[k] != "open":
                continue
            near = [(abs(place - p), labels[members[p]] != "good", p) for p in (before[place], after[place]) if p is not None]
            if near:
                out[k] = labels[members[min(near)[2]]]
            else:
                out[k] = "good" if page_blocks[k].in_article else "bad"
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    return " ".join(b.text for b, label in zip(found, settled(found)) if label == "good")


def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per page: identifier, address, main text and its length in code points."""
    on_workers(pages.sparkSession)
    rows = pages.select(pages[id_column].cast("long"), pages[url_column], F.coalesce(pages[html_column], F.lit("")))
    found = rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
    return found.withColumnsRenamed({"page_id": id_column, "url": url_column})
