"""Operator 11: main text of HTML pages by removal of site templates.

Each page is parsed once, in the tasks, into its text blocks and the list of
its elements, each with the hash of its subtree (tags and text, no attributes)
and the range of blocks that it holds.  Spark counts, per host and hash, on how many
different articles a subtree stands; subtrees that recur on many pages of their
host are its template and their blocks go.  The blocks are written once; the
recurring subtrees come back to them as a join on host and hash, so no list of
a host's templates is ever gathered in one place.

Copies of one article are no template: pages count by their longest block, an
element that holds its page's longest block is never removed, and neither is
prose (a paragraph, heading or the like) of an `article` or `main`, as passages are
quoted between articles.  What a page's markup itself calls navigation, advert,
form, comments and so on goes on every page, recurring or not, and where a page has an
`article` or `main`, only what lies in it stays.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import materialise

#: A subtree that stands on so many different articles of a host is part of its template.
MIN_PAGES = 5

# HTML element names by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd caption li td th tr".split())
_BLOCK = _PROSE | frozenset(
    "html head body div section article main header footer nav aside address center details summary dialog dir dl fieldset figure "
    "form hgroup hr legend menu ol option optgroup table tbody thead tfoot title ul search select textarea button".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_DROPPED = frozenset(
    "head title script style noscript template svg canvas iframe object embed audio video map nav footer aside form button input select textarea "
    "fieldset dialog menu search noembed noframes xmp datalist".split())
# ARIA roles and words of class and id names that mark what is not the article.
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tablist".split())
_WORDS = frozenset(
    "nav navbar navigation menu menubar footer sidebar aside ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations trending comment comments disqus respond replies reply breadcrumb breadcrumbs pagination pager widget toolbar "
    "masthead skip skiplink form search tagcloud outbrain taboola header".split())
_NEGATED = frozenset("has with no without not is".split())
#: An element that opens closes those of the first list, up to one of the second.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "body": (("head",), ("html",)),
}
_TOKEN = re.compile(r"<!--(?:.*?--!?>|>|->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[='\"])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class _Element:
    __slots__ = ("digest", "drop", "first", "main", "tag")

    def __init__(self, tag: str, first: int, drop: int, main: bool):
        self.tag, self.first, self.drop, self.main = tag, first, drop, main
        self.digest = hashlib.blake2b(tag.encode(), digest_size=8)


#: Why text goes: not at all, except for headings, always.
_KEPT, _HEADINGS_ONLY, _GONE = 0, 1, 2


def _named(attributes: str) -> tuple[int, bool]:
    """(what the attributes say about the text, whether they mark the article's body)."""
    verdict, body = _KEPT, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "role" and value.lower() in _ROLES):
            verdict = _GONE
        elif name == "role":
            body |= value.lower() == "main"
        elif name == "itemprop":
            body |= value.lower() == "articlebody"
        elif name in ("class", "id"):
            for part in value.split():
                found = [w.lower() for w in _NAME_WORD.findall(part)]
                if found and found[0] not in _NEGATED:
                    for w in found:
                        if w in _WORDS:
                            verdict = max(verdict, _HEADINGS_ONLY if w == "header" else _GONE)
    return verdict, body


class Page:
    """Blocks and elements of one page.

    blocks: (text, kept by the markup, inside the article); elements: (subtree hash,
    first block, last block, prose, inside the article) of all block elements with text.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, bool, bool]] = []
        self.elements: list[tuple[int, int, int, bool, bool]] = []
        self.stack = [_Element("", 0, _KEPT, False)]
        self.text: list[str] = []
        self._read(html)
        while len(self.stack) > 1:
            self._close()
        self._end_block()

    def _read(self, html: str) -> None:
        at, raw = 0, None
        while True:
            if raw is not None:
                end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(html, at)
                self._say(html[at: end.start() if end else len(html)], raw in ("title", "textarea"))
                if not end:
                    return
                at, raw = end.start(), None
            m = _TOKEN.search(html, at)
            if not m:
                self._say(html[at:])
                return
            if m.start() > at:
                self._say(html[at: m.start()])
            at = m.end()
            if not m[2] or (m[0][-1] != ">"):
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            else:
                self._start(tag, m[3])
                if tag in _RAW:
                    raw = tag

    def _say(self, text: str, decoded: bool = True) -> None:
        if text:
            self.text.append(unescape(text) if decoded and "&" in text else text)

    def _end_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text.clear()
            if text:
                top = self.stack[-1]
                heading = top.drop == _HEADINGS_ONLY and any(e.tag in _HEADINGS for e in reversed(self.stack))
                self.blocks.append((text, top.drop == _KEPT or heading, top.main))
                top.digest.update(b"\0" + text.encode("utf-8", "replace") + b"\0")

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag in _BLOCK:
            self._end_block()
            if tag in _CLOSES:
                closes, bounds = _CLOSES[tag]
                for k in range(len(self.stack) - 1, 0, -1):
                    if self.stack[k].tag in bounds:
                        break
                    if self.stack[k].tag in closes:
                        self._pop_to(k)
                        break
            elif any(e.tag == "p" for e in self.stack[-8:]):
                self._end("p")
        if tag in _VOID:
            return
        above = self.stack[-1]
        verdict, body = _named(attributes) if attributes.strip(" /") else (_KEPT, False)
        if tag in ("html", "body"):
            verdict = _KEPT
        if tag in _DROPPED:
            verdict = _GONE
        elif tag == "header":
            verdict = max(verdict, _HEADINGS_ONLY if above.main else _GONE)
        elif tag in ("article", "main") or body:
            body = True
        if verdict == _HEADINGS_ONLY and not above.main and not body:
            verdict = _GONE
        if tag in _BLOCK or verdict != _KEPT:
            self._end_block()
        self.stack.append(_Element(tag, len(self.blocks), max(above.drop, verdict), above.main or (body and max(above.drop, verdict) != _GONE)))

    def _close(self) -> None:
        closed = self.stack[-1]
        if closed.tag in _BLOCK or closed.drop != self.stack[-2].drop:
            self._end_block()
        self.stack.pop()
        digest = closed.digest.digest()
        self.stack[-1].digest.update(digest)
        if closed.tag in _BLOCK and len(self.blocks) > closed.first:
            self.elements.append((int.from_bytes(digest, "big", signed=True), closed.first, len(self.blocks) - 1, closed.tag in _PROSE, closed.main))

    def _pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            self._close()

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self._end_block()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                self._pop_to(k)
                return
            # a paragraph or an inline element does not close what encloses it
            if tag not in _BLOCK or tag == "p":
                if self.stack[k].tag in _BLOCK and self.stack[k].tag != "p":
                    return

    def kept(self) -> list[bool]:
        """Blocks that the markup leaves: those in the article if there is one with text, else all that are not dropped."""
        inside = any(k and main for _, k, main in self.blocks)
        return [k and (main or not inside) for _, k, main in self.blocks]

    def candidates(self) -> tuple[int, list[tuple[int, int, int, bool]]]:
        """(hash of the longest kept block, 0 if none; elements that may be template: hash, first and last block, whether any of these is kept)."""
        kept = self.kept()
        longest = max((k for k in range(len(kept)) if kept[k]), key=lambda k: (len(self.blocks[k][0]), -k), default=-1)
        mark = hashlib.blake2b(self.blocks[longest][0].encode("utf-8", "replace"), digest_size=8).digest() if longest >= 0 else bytes(8)
        before = [0, *accumulate(kept)]
        found = [(h, a, b, before[b + 1] > before[a]) for h, a, b, prose, main in self.elements if not a <= longest <= b and not (prose and main)]
        return int.from_bytes(mark, "big", signed=True), found


def parsed_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(row, page_id, url, host, mark, blocks, elements) of every row; blocks that the markup drops are null."""

    def run(batches):
        for batch in batches:
            marks, blocks, elements = [], [], []
            for text in batch.column("html").to_pylist():
                page = Page(text or "")
                mark, found = page.candidates()
                marks.append(mark)
                blocks.append([b[0] if k else None for b, k in zip(page.blocks, page.kept(), strict=True)])
                elements.append([dict(zip(("hash", "first", "last", "open"), e, strict=True)) for e in found])
            kind = pa.list_(pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("open", pa.bool_())]))
            columns = [*(batch.column(c) for c in ("row", "page_id", "url", "host")), pa.array(marks, pa.int64()), pa.array(blocks, pa.list_(pa.string())), pa.array(elements, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "page_id", "url", "host", "mark", "blocks", "elements"])

    url_text = F.col(url).cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url_text, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page_id"), url_text.alias("url"), host.alias("host"), F.col(html).cast("string").alias("html"))
    key = pages.schema[page_id].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, page_id {key}, url string, host string, mark long, blocks array<string>, elements array<struct<hash:long,first:int,last:int,open:boolean>>")


def site_templates(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash, n_pages) of subtrees on at least `min_pages` different articles of a host.

    Copies of an article have the same longest block and count once.  The
    distinct rows are aggregated in the tasks before they travel, so a hot
    host's template costs a row per task and article.
    """
    each = parsed.select("host", "mark", F.explode(F.array_distinct(F.transform("elements", lambda e: e["hash"]))).alias("hash"))
    return each.distinct().groupBy("host", "hash").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_template_blocks) of every row of `pages`.

    text is the blocks that stay, in page order, joined by an empty line; n_chars
    its code points.  Null or empty html, or html without an article: empty text.  A null or
    malformed url has the empty host, which is a host like any other.  Rows that repeat a
    page_id are rows of their own.  Other columns are not read, whatever their names.
    """
    parsed = materialise(parsed_pages(pages, page_id, url, html), "pages")
    templates = materialise(site_templates(parsed, min_pages).select("host", "hash"), "templates")
    # subtrees without a block that is still there need no look-up
    each = parsed.select("row", "host", F.explode(F.filter("elements", lambda e: e["open"])).alias("e")).select("row", "host", F.col("e.hash").alias("hash"), F.col("e.first").alias("first"), F.col("e.last").alias("last"))
    ranges = each.join(templates, ["host", "hash"]).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("gone"))
    joined = parsed.drop("host", "mark", "elements").join(materialise(ranges, "ranges"), "row", "left")
    inside = lambda k: F.exists("gone", lambda g: (g["first"] <= k) & (k <= g["last"]))
    left = F.filter("blocks", lambda b, k: b.isNotNull() & ~F.coalesce(inside(k), F.lit(False)))
    shown = F.filter("blocks", lambda b: b.isNotNull())
    out = joined.select("page_id", "url", F.array_join(left, "\n\n").alias("text"), (F.size(shown) - F.size(left)).cast("long").alias("n_template_blocks"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template_blocks")
