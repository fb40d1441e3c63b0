"""Per-site rules ("different for each website") as one value object."""

from __future__ import annotations

from dataclasses import dataclass, field

from corpusflow.functions.urls import NAVIGATION_MARKS
from corpusflow.operators.html import ARTICLE_CLASSES, BLOCK_TAGS, SKIP_P_CLASSES


@dataclass(frozen=True)
class SiteRules:
    """Site-specific knobs of the crawl and parse passes.

    ``article_classes=None`` takes every ``<article>``; ``url_pattern`` (a
    regex searched in the URL) keeps only matching article links.
    """
    article_classes: tuple[str, ...] | None = ARTICLE_CLASSES
    block_tags: tuple[str, ...] = BLOCK_TAGS
    skipped_classes: tuple[str, ...] = SKIP_P_CLASSES
    nav_marks: tuple[str, ...] = field(default_factory=lambda: tuple(NAVIGATION_MARKS))
    url_pattern: str | None = None
    date_format: str = "yyyy-MM-dd'T'HH:mm:ssXXX"
