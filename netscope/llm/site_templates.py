"""Main text of web pages by removal of site templates.

Every element subtree of a page is hashed (tag, text, child hashes).  Spark counts, per host, on how
many distinct pages each subtree occurs; subtrees that stand on ``MIN_PAGES`` of them are the site's
template and are deleted.  What remains is read block by block, without the elements whose kind marks
them as something else than the article (menus, forms, scripts, comments ...), and within
``article``/``main`` where a page has one.

The number is absolute, so it does not depend on the size of a host, and what recurs in one section of a
host recurs on the host.  Pages of a host whose texts are equal count once.  Blocks of an
``article``/``main`` take part like all others; but where more than half of an article's blocks and of
its letters recur, the page is a copy of an article with changes, and only its link lists go.

Words of class, id and role mark an element if a whole word of the attribute consists of them; if only a
part does (``related-posts``), the element must hold mostly links and less than half of the page.  No word
drops ``html``, ``body``, ``main``, ``article`` or an element around one of them; only reader comments that
follow a main element or stand in one go whole, ``article`` elements within them and comments that are
``article`` elements themselves included.

Parsing takes time linear in a page: open elements are found by name, an unclosed tag isn't scanned twice, and
ranges of blocks are marked by their ends.

A batch sends at most ``MIN_PAGES`` rows per (host, subtree) to the count, and a page gets back only its
own recurring subtrees, so a host with a third of all pages needs no task of its own.

Null and blank pages have an empty text; without a host, pages count under the empty host; repeated
rows each get their text; an empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import table

NAME = "op7_site_templates"
MIN_PAGES = 4

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
NOT_TEXT = frozenset("""head nav footer aside form menu dialog button select option datalist svg canvas object audio
    video map""".split())
CLOSES = {  # an opening tag ends these open elements, up to the boundary element
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
# Words of class, id and role that mark something else than the article.
MARKS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup paywall nav navbar
    navigation menu breadcrumb breadcrumbs pagination pager toolbar sidebar aside related recommended widget share
    sharing social comment comments reply replies disqus footer masthead skip search login complementary
    contentinfo""".split())
HEADER_MARKS = frozenset(("header", "site-header"))
COMMENT_MARKS = frozenset("comment comments reply replies disqus".split())
# How an element is marked: by its tag or as hidden, by a whole word, by a part of a word, as reader comments.
KIND, WORD, PART, COMMENT = 1, 2, 3, 4

# No "<" outside quotes in a tag: at most three unfinished tags (one a state of quoting) are read at any place.
_IN_TAG = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b" + _IN_TAG + r">.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)(" + _IN_TAG + r")>|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_INVISIBLE = re.compile(r"display\s*:\s*none")
_PART = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "dropped", "content", "hash", "chars", "linked", "first", "mutes", "mark", "at")

    def __init__(self, tag: str, dropped: bool, content: bool, first: int, mark: int = 0, at: int = 0):
        self.tag, self.dropped, self.content, self.first, self.mark, self.at = tag, dropped, content, first, mark, at
        self.hash = xxhash.xxh3_64(tag.encode())
        self.chars = self.linked = 0
        self.mutes = False  # an inline element whose text is left out of the block around it


def _spread(ranges: list[tuple[int, int]], n: int) -> list[bool]:
    """Which of ``n`` places lie in a range."""
    ends = [0] * (n + 1)
    for a, b in ranges:
        ends[a] += 1
        ends[b] -= 1
    return [x > 0 for x in accumulate(ends)][:n]


def _marked(tag: str, attributes: str, in_content: bool) -> tuple[int, bool]:
    """How tag or attributes say that an element isn't part of the article, and whether it is a main element."""
    main = tag in ("article", "main")
    if tag in NOT_TEXT or (tag == "header" and not in_content):
        return KIND, main
    if tag in ("html", "body") or not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return 0, main
    mark = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _INVISIBLE.search(value):
            return KIND, main
        if name not in ("class", "id", "role"):
            continue
        main = main or name == "role" and value == "main"
        for word in value.split():
            parts = _PART.findall(word)
            if word in MARKS or (not in_content and word in HEADER_MARKS) or parts and MARKS.issuperset(parts):
                if word in COMMENT_MARKS or not COMMENT_MARKS.isdisjoint(parts):
                    mark = COMMENT
                mark = mark if mark == COMMENT else WORD
            elif not mark and not MARKS.isdisjoint(parts):
                mark = PART
    return 0 if main and mark != COMMENT else mark, main


class Page:
    """Blocks and subtrees of one page."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[str, bool, bool]] = []   # text, inside article or main, dropped by its kind
        self.subtrees: list[tuple[int, int, int, bool]] = []   # hash, first block, block after the last, mostly links
        self._spared: set[int] = set()   # where elements start that hold a main element: no word marks them
        source, known = source or "", -1
        while known < len(self._spared):
            known = len(self._spared)
            self._read(source)

    def _read(self, source: str) -> None:
        self.blocks.clear()
        self.subtrees.clear()
        self.has_content = False
        self._parts: list[str] = []
        self._partly: list[tuple[int, int, int]] = []   # first block, block after the last, letters
        root = Element("", False, False, 0)
        self._stack, self._links, self._muted = [root], 0, 0
        self._places: dict[str, list[int]] = defaultdict(list)   # where open elements of a name stand in the stack
        self._open_marks: list[Element] = []   # open elements with a mark that a main element inside takes away
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            tag = (m[3] or "").lower()
            if not tag:
                continue
            if m[2]:
                self._close(tag)
            else:
                self._open(tag, m[4], m.start())
        if at < len(source):
            self._text(source[at:])
        while len(self._stack) > 1:
            self._pop()
        self._flush()
        partly = _spread([(a, b) for a, b, chars in self._partly if 2 * chars < root.chars], len(self.blocks))
        self.blocks[:] = [(t, content, dropped or p) for (t, content, dropped), p in zip(self.blocks, partly)]

    def _text(self, raw: str) -> None:
        if self._muted:
            return
        text = htmllib.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        self._links += len(text) if any(e.tag == "a" for e in self._stack[-3:]) else 0

    def _flush(self) -> None:
        """Ends the block that is open."""
        text = " ".join("".join(self._parts).split())
        self._parts.clear()
        if text:
            top = self._stack[-1]
            self.blocks.append((text, top.content, top.dropped))
            top.hash.update(text.encode("utf-8", "surrogatepass"))
            top.chars += len(text)
            top.linked += self._links
        self._links = 0

    def _open(self, tag: str, attributes: str, at: int) -> None:
        if tag == "p" or tag in BLOCK:
            self._flush()
            if self._places["p"]:
                self._end(("p",), ("article", "main", "section", "td", "li", "body", "div"))
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        if tag in VOID:
            if tag == "br":
                self._parts.append(" ")
            return
        if attributes.endswith("/") and tag not in BLOCK:
            return
        top = self._stack[-1]
        if tag not in BLOCK:
            mark = KIND if tag in NOT_TEXT else _marked(tag, attributes, top.content)[0] if attributes else 0
            if mark == COMMENT and not self.has_content:
                mark = WORD
            drops = mark in (KIND, COMMENT) or mark == WORD and at not in self._spared
            if tag == "a" or drops:
                new = Element(tag, top.dropped, top.content, len(self.blocks), mark if drops else 0, at)
                new.mutes = drops
                self._muted += new.mutes
                self._push(new)
            return
        mark, main = _marked(tag, attributes, top.content)
        if mark == COMMENT and not self.has_content:
            mark = 0 if main else WORD
        if main and mark != COMMENT or tag in ("html", "body"):
            for e in self._open_marks:
                if e.mark == WORD:
                    self._spared.add(e.at)
                else:
                    e.mark = 0
            self._open_marks.clear()
        if mark == WORD and at in self._spared:
            mark = 0
        dropped = top.dropped or mark in (KIND, WORD, COMMENT)
        content = top.content or (not dropped and main)
        self.has_content |= content
        self._push(Element(tag, dropped, content, len(self.blocks), mark, at))

    def _push(self, new: Element) -> None:
        self._places[new.tag].append(len(self._stack))
        self._stack.append(new)
        if new.mark in (WORD, PART):
            self._open_marks.append(new)

    def _innermost(self, tags: tuple[str, ...]) -> int:
        """Place in the stack of the innermost open element of ``tags``, 0 if there is none."""
        return max((self._places[t][-1] for t in tags if self._places[t]), default=0)

    def _end(self, tags: tuple[str, ...], boundary: tuple[str, ...]) -> None:
        """Closes the innermost open element of ``tags`` unless a boundary element lies above it."""
        place = self._innermost(tags)
        if place > self._innermost(boundary):
            while len(self._stack) > place:
                self._pop()

    def _close(self, tag: str) -> None:
        if self._places[tag]:
            place = self._places[tag][-1]
            while len(self._stack) > place:
                self._pop()
        elif tag in BLOCK:
            self._flush()

    def _pop(self) -> None:
        top, parent = self._stack[-1], self._stack[-2]
        if top.tag in BLOCK:
            self._flush()
        self._muted -= top.mutes
        self._stack.pop()
        self._places[top.tag].pop()
        if self._open_marks and self._open_marks[-1] is top:
            self._open_marks.pop()
        parent.hash.update(top.hash.digest())
        parent.chars += top.chars
        parent.linked += top.linked
        if top.chars and top.tag in BLOCK and top.first < len(self.blocks):
            links = 2 * top.linked > top.chars
            if top.tag not in ("body", "html", "article", "main"):
                self.subtrees.append((top.hash.intdigest() - 2 ** 63, top.first, len(self.blocks), links))
            if top.mark == PART and links:
                self._partly.append((top.first, len(self.blocks), top.chars))

    def visible(self) -> list[bool]:
        """Which blocks are read if nothing recurs."""
        return [not dropped and (content or not self.has_content) for _, content, dropped in self.blocks]

    def body(self) -> int:
        """Hash of the text if nothing recurs."""
        return xxhash.xxh3_64_intdigest(self.text(set()).encode("utf-8", "surrogatepass")) - 2 ** 63

    def removable(self) -> set[int]:
        """Subtrees with a block that is read if nothing recurs."""
        before = [0]
        for v in self.visible():
            before.append(before[-1] + v)
        return {h for h, a, b, _ in self.subtrees if before[b] > before[a]}

    def text(self, recurring: set[int]) -> str:
        """Text without the recurring subtrees."""
        read, n = self.visible(), len(self.blocks)
        inside = [0, *accumulate(content for _, content, _ in self.blocks)]
        gone, again = [], []
        for h, a, b, links in self.subtrees:
            if h in recurring:
                (gone if links or inside[a] == inside[b] else again).append((a, b))
        read = [r and not x for r, x in zip(read, _spread(gone, n))]
        shared = _spread(again, n)
        if any(shared):
            sizes = [len(t) * r for (t, _, _), r in zip(self.blocks, read)]
            again = [n for n, x in zip(sizes, shared) if n and x]
            copy = 2 * len(again) > sum(read) and 2 * sum(again) > sum(sizes)
            read = [r and (copy or not x) for r, x in zip(read, shared)]
        return "\n".join(t for (t, _, _), r in zip(self.blocks, read) if r)


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    return pages.select(F.col(key).alias("key"), F.xxhash64(_host(url)).alias("host"), F.col(html).alias("html"))


def recurring(pages: DataFrame, key: str, url: str, html: str, min_pages: int) -> DataFrame:
    """``tree`` (hash of host and subtree) of the subtrees on at least ``min_pages`` distinct pages of their host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, bodies = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for host, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                page = Page(x.as_py())
                trees.append(np.array([h for h, *_ in page.subtrees], np.int64) ^ host)
                bodies.append(np.full(len(trees[-1]), page.body(), np.int64))
            rows = np.unique(np.stack([np.concatenate(trees), np.concatenate(bodies)], 1), axis=0)
            first = np.searchsorted(rows[:, 0], rows[:, 0])
            rows = rows[np.arange(len(rows)) - first < min_pages]  # more of them say no more
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["tree", "body"])

    found = _pages(pages, key, url, html).mapInArrow(run, "tree bigint, body bigint")
    return found.repartition("tree").groupBy("tree").agg(F.countDistinct("body").alias("n")).filter(
        F.col("n") >= min_pages).select("tree")


def removable(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """``key, tree``: the subtrees of every page that are read if they don't recur."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [np.array(sorted(Page(x.as_py()).removable()), np.int64) ^ host
                     for host, x in zip(batch.column(1).to_pylist(), batch.column(2))]
            rows = np.repeat(np.arange(len(trees)), [len(t) for t in trees])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(
                np.concatenate([np.zeros(0, np.int64), *trees]))], names=["key", "tree"])

    return _pages(pages, key, url, html).mapInArrow(run, f"key {kind}, tree bigint")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """``key, url, text, n_chars`` of every page."""
    kind = pages.schema[key].dataType.simpleString()
    template = recurring(pages, key, url, html, min_pages)
    mine = removable(pages, key, url, html).join(template, "tree").groupBy("key").agg(F.collect_set("tree").alias("trees"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).join(
        mine, "key", "left").select("key", "url", "html", "trees", F.xxhash64(_host("url")).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(x.as_py()).text({t ^ host for t in trees.as_py() or ()}) for x, trees, host in zip(
                batch.column(2), batch.column(3), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["key", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"key {kind}, url string, text string, n_chars bigint").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
