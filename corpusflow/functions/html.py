"""JVM-side HTML field extraction (P11-P14) with regular expressions.

Cheaper than a Python parse when only head fields are needed; the full
body-text semantics live in ``operators.html`` (a real parser).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import unescape_html
from corpusflow.operators.links import visible_html

TITLE_REGEX = r"(?is)<title[^>]*>(.*?)</title>"
META_TAG_REGEX = r"""(?is)<meta\b(?:[^>"']|"[^"]*"|'[^']*')*+>"""
CONTENT_ATTR_REGEX = r"""(?is)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')"""


def _attr_is(tag: Column, attr: str, value: str) -> Column:
    return tag.rlike(r"(?is)\b" + attr + r"""\s*=\s*["']?""" + value.replace(":", r"\:")
                     + r"""(["'\s/>]|$)""")


def page_title(html: Column) -> Column:
    """Text of the first ``<title>``, unstripped, entities unescaped; "" if none."""
    return unescape_html(F.regexp_extract(visible_html(html), TITLE_REGEX, 1))


def meta_contents(html: Column, attr: str, value: str) -> Column:
    """``content`` of every ``<meta attr="value">`` in document order."""
    tags = F.filter(F.regexp_extract_all(visible_html(html), F.lit(META_TAG_REGEX), 0),
                    lambda t: _attr_is(t, attr, value))
    return F.transform(tags, lambda t: unescape_html(F.concat(
        F.regexp_extract(t, CONTENT_ATTR_REGEX, 1), F.regexp_extract(t, CONTENT_ATTR_REGEX, 2))))


def page_authors(html: Column) -> Column:
    """Non-empty author metas; none -> ``["NOT FOUND"]``."""
    found = F.filter(meta_contents(html, "name", "author"), lambda a: a != "")
    return F.when(F.size(found) == 0, F.array(F.lit("NOT FOUND"))).otherwise(found)


def page_date_text(html: Column) -> Column:
    """Content of the first ``article:published_time`` meta (null if none)."""
    first = F.get(meta_contents(html, "property", "article:published_time"), 0)
    return F.when(first != "", first)


def page_topics(html: Column) -> Column:
    """Keywords (comma-separated) then ``article:tag`` metas; empty array if none."""
    kw = F.flatten(F.transform(meta_contents(html, "name", "keywords"),
                               lambda v: F.transform(F.split(v, ","), lambda t: F.trim(t))))
    tags = meta_contents(html, "property", "article:tag")
    return F.filter(F.concat(kw, tags), lambda t: t != "")
