"""HTML extraction (U5, P10-P16): one streaming parse per page in a Python
worker (``mapInPandas``), yielding title, author / date / keyword metas, the
article body text and selected elements.

The parser is the standard library's ``html.parser`` with the implied end
tags of lenient HTML parsers added (a new ``<p>`` closes an open ``<p>`` and
inline font-style tags, ``<li>`` closes ``<li>``, headings close ``<p>``, ...).
Text of an element is every descendant text node stripped and glued without
a separator; ``<script>``, ``<style>`` and comments hold no text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.session import ship_package, spread

# --- fixed values -----------------------------------------------------------
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li")
ARTICLE_CLASSES = ("type-post", "type-page")
SKIP_P_CLASSES = ("has-medium-font-size",)
NOT_FOUND_AUTHOR = "NOT FOUND"
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link",
                       "meta", "param", "source", "track", "wbr"))
FONT_STYLE = frozenset(("tt", "i", "b", "u", "s", "strike", "big", "small"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# New start tag -> open elements it closes (innermost first, while they match).
AUTO_CLOSE = {
    "p": frozenset({"p", "head"}) | HEADINGS | FONT_STYLE,
    "li": frozenset({"p", "dl", "address", "pre", "listing", "xmp", "head", "li"}) | HEADINGS,
    "div": frozenset({"p", "head"}),
    "ul": frozenset({"p", "head", "ol", "menu", "dir", "address", "pre", "listing", "xmp"}),
    "ol": frozenset({"p", "head", "ul"}),
    "table": frozenset({"p", "head", "pre", "listing", "xmp", "a"}) | HEADINGS,
    "hr": frozenset({"p", "head"}),
    "pre": frozenset({"p", "head", "ul"}),
    "blockquote": frozenset({"p", "head"}),
    "dl": frozenset({"p", "dt", "menu", "dir", "address", "pre", "listing", "xmp", "head"}),
    "body": frozenset({"head", "style", "script", "title"}),
    **{h: frozenset({"p", "head"}) | HEADINGS for h in HEADINGS},
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Selector:
    """P10: select elements by tag, class or both; take text or an attribute."""
    name: str
    tag: str | None = None
    cls: str | None = None
    attr: str | None = None

    def matches(self, tag: str, classes: list[str]) -> bool:
        return (self.tag is None or self.tag == tag) and (self.cls is None or self.cls in classes)


@dataclass
class _Frame:
    tag: str
    records: list[list[str]] = field(default_factory=list)
    article: list[list[str]] | None = None
    is_title: bool = False
    raw_text: bool = False


class PageParser(HTMLParser):
    """Collect everything P10-P15 need in one pass over a page."""

    def __init__(self, article_classes: tuple[str, ...] | None = ARTICLE_CLASSES,
                 selectors: tuple[Selector, ...] = (), block_tags: tuple[str, ...] = BLOCK_TAGS,
                 skipped_classes: tuple[str, ...] = SKIP_P_CLASSES) -> None:
        super().__init__(convert_charrefs=True)
        self.article_classes = article_classes
        self.block_tags = block_tags
        self.skipped_classes = skipped_classes
        self.selectors = selectors
        self.stack: list[_Frame] = []
        # the blocks of each matching article, nested articles after the outer one
        self.articles: list[list[list[str]]] = []
        self.selected: list[tuple[str, int, str, str, list[str] | str]] = []
        self.title_parts: list[str] | None = None
        self.title_done = False
        self.metas: list[dict[str, str]] = []
        self.raw_depth = 0

    # -- structure ---------------------------------------------------------
    def _auto_close(self, tag: str) -> None:
        closes = AUTO_CLOSE.get(tag)
        while closes and self.stack and self.stack[-1].tag in closes:
            self._pop()

    def _pop(self) -> None:
        frame = self.stack.pop()
        if frame.raw_text:
            self.raw_depth -= 1
        if frame.is_title:
            self.title_done = True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: (v or "") for k, v in attrs}
        if tag == "meta":
            self.metas.append(a)
        self._auto_close(tag)
        if tag in VOID_TAGS:
            self._select(tag, a, push=None)
            return
        frame = _Frame(tag)
        classes = a.get("class", "").split()
        if tag == "article" and (self.article_classes is None
                                 or any(c in classes for c in self.article_classes)):
            frame.article = []
            self.articles.append(frame.article)
        if tag in ("script", "style", "template"):
            frame.raw_text = True
            self.raw_depth += 1
        if tag == "title" and self.title_parts is None:
            frame.is_title = True
            self.title_parts = []
        inside = [f.article for f in self.stack if f.article is not None]
        if (inside and tag in self.block_tags
                and not (tag == "p" and any(c in classes for c in self.skipped_classes))):
            parts: list[str] = []
            for blocks in inside:
                blocks.append(parts)
            frame.records.append(parts)
        self._select(tag, a, push=frame)
        self.stack.append(frame)

    def _select(self, tag: str, attrs: dict[str, str], push: _Frame | None) -> None:
        if not self.selectors:
            return
        classes = attrs.get("class", "").split()
        for sel in self.selectors:
            if sel.matches(tag, classes):
                if sel.attr is not None:
                    self.selected.append((sel.name, tag, " ".join(classes), attrs.get(sel.attr)))
                else:
                    parts: list[str] = []
                    self.selected.append((sel.name, tag, " ".join(classes), parts))
                    if push is not None:
                        push.records.append(parts)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack and self.stack[-1].tag == tag:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data: str) -> None:
        if self.raw_depth:
            return
        if self.title_parts is not None and not self.title_done:
            self.title_parts.append(data)
        s = data.strip()
        if not s:
            return
        for frame in self.stack:
            for parts in frame.records:
                parts.append(s)

    # -- results -----------------------------------------------------------
    def body_text(self) -> str:
        texts = ("".join(parts) for blocks in self.articles for parts in blocks)
        return "\n".join(t for t in texts if t)

    def title(self) -> str:
        return "".join(self.title_parts or [])

    def meta_values(self, key: str, value: str) -> list[str]:
        return [m.get("content", "") for m in self.metas if m.get(key) == value]

    def authors(self) -> list[str]:
        found = [v for v in self.meta_values("name", "author") if v]
        return found or [NOT_FOUND_AUTHOR]

    def published(self) -> str | None:
        vals = self.meta_values("property", "article:published_time")
        return vals[0] if vals and vals[0] else None

    def topics(self) -> list[str]:
        out: list[str] = []
        for v in self.meta_values("name", "keywords"):
            out.extend(t.strip() for t in v.split(",") if t.strip())
        out.extend(v for v in self.meta_values("property", "article:tag") if v)
        return out


def parse_html(html: str | None, article_classes: tuple[str, ...] | None = ARTICLE_CLASSES,
               selectors: tuple[Selector, ...] = (), block_tags: tuple[str, ...] = BLOCK_TAGS,
               skipped_classes: tuple[str, ...] = SKIP_P_CLASSES) -> PageParser:
    p = PageParser(article_classes, selectors, block_tags, skipped_classes)
    if html:
        p.feed(html)
        p.close()
    return p


PARSED_SCHEMA = ("page_id bigint, url string, title string, author array<string>, "
                 "date_raw string, topics array<string>, text string")


def parse_pages(pages: DataFrame, article_classes: tuple[str, ...] | None = ARTICLE_CLASSES,
                default_ts=None, rules=None, keep_html: bool = False) -> DataFrame:
    """Title, authors, date, topics and body text of every page.

    One ``mapInPandas`` pass (Arrow batches, no shuffle); the date text is
    turned into a timestamp on the JVM side (X4), missing dates take
    ``default_ts`` (null unless given).  ``rules`` (a ``SiteRules``) gives the
    article classes, block tags, skipped classes and the date format of a
    site; ``keep_html`` passes the page on beside its fields.
    """
    block_tags, skipped = BLOCK_TAGS, SKIP_P_CLASSES
    if rules is not None:
        article_classes = rules.article_classes
        block_tags, skipped = tuple(rules.block_tags), tuple(rules.skipped_classes)
    classes = tuple(article_classes) if article_classes is not None else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                p = parse_html(html, classes, (), block_tags, skipped)
                rows.append((pid, url, p.title(), p.authors(), p.published(), p.topics(),
                             p.body_text()) + ((html,) if keep_html else ()))
            yield pd.DataFrame(rows, columns=["page_id", "url", "title", "author", "date_raw",
                                              "topics", "text"] + ["html"] * keep_html)

    from corpusflow.functions.dates import ISO_OFFSET_FORMAT, site_date, unify_date
    ship_package(pages.sparkSession)
    out = spread(pages.select("page_id", "url", "html")).mapInPandas(
        run, PARSED_SCHEMA + ", html string" * keep_html)
    own_format = rules.date_format if rules is not None else ISO_OFFSET_FORMAT
    date = unify_date(F.col("date_raw")) if own_format == ISO_OFFSET_FORMAT else site_date(F.col("date_raw"), own_format)
    if default_ts is not None:
        date = F.coalesce(date, F.lit(default_ts).cast("timestamp_ntz"))
    return out.select("page_id", "url", "title", "author", date.alias("date"), "topics", "text",
                      *["html"] * keep_html)


def meta_page_checks(meta: DataFrame) -> DataFrame:
    """Are a page's meta fields true of the page?  Adds ``title_found, author_ok,
    date_ok, topics_ok, has_text`` to rows with the fields and the page's ``html``
    (``parse_pages(..., keep_html=True)``, or META joined to its pages).

    Author: every name is in the page, or the not-found mark alone.  Date: there
    is one and it is written as the meta date pattern.  Topics: each is in the page.
    """
    from corpusflow.functions.dates import date_to_text, looks_like_meta_date
    from corpusflow.functions.text import title_in_html
    page = F.col("html")
    author_ok = F.forall("author", lambda a: page.contains(a)) | (F.col("author") == F.array(F.lit(NOT_FOUND_AUTHOR)))
    return meta.withColumns({
        "title_found": title_in_html(F.col("title"), page), "author_ok": author_ok,
        "date_ok": looks_like_meta_date(date_to_text(F.col("date"))),
        "topics_ok": F.forall("topics", lambda t: page.contains(t)), "has_text": F.col("text") != ""})


def html_select(pages: DataFrame, selectors: list[Selector]) -> DataFrame:
    """P10: elements matching each selector in document order ->
    ``(page_id, selector, pos, tag, classes, value)``."""
    sels = tuple(selectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for pid, html in zip(pdf["page_id"], pdf["html"]):
                p = parse_html(html, None, sels)
                counters: dict[str, int] = {}
                for name, tag, classes, val in p.selected:
                    pos = counters.get(name, 0)
                    counters[name] = pos + 1
                    value = "".join(val) if isinstance(val, list) else val
                    rows.append((pid, name, pos, tag, classes, value))
            yield pd.DataFrame(rows, columns=["page_id", "selector", "pos", "tag", "classes",
                                              "value"])

    ship_package(pages.sparkSession)
    return spread(pages.select("page_id", "html")).mapInPandas(
        run, "page_id bigint, selector string, pos int, tag string, classes string, value string")
