"""URL column functions: absolute test, resolution against a seed, host,
fragment strip, path segments, URL parts (P2-P5, P8, P9, X7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Path segments that mark a navigation (listing) page rather than an article.
NAVIGATION_MARKS = ["category", "tag", "page"]
# Absolute-URL test: anchored, case-sensitive.
ABSOLUTE_URL_REGEX = r"^https?://"
# ---------------------------------------------------------------------------

# scheme://netloc, netloc ends at the first of / ? #
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_NETLOC = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"#(.*)$"


def is_absolute(url: Column) -> Column:
    """Starts with ``http://`` or ``https://``."""
    return url.rlike(ABSOLUTE_URL_REGEX)


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def netloc_of(url: Column) -> Column:
    """Network location including user info and port ("" if none)."""
    return F.regexp_extract(url, _NETLOC, 1)


def path_with_params(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def path_of(url: Column) -> Column:
    """Path of an absolute URL; ``;params`` of the last segment cut off."""
    return F.regexp_replace(path_with_params(url), r";[^/]*$", "")


def params_of(url: Column) -> Column:
    return F.regexp_extract(path_with_params(url), r";([^/]*)$", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, _QUERY, 1)


def fragment_of(url: Column) -> Column:
    return F.regexp_extract(url, _FRAGMENT, 1)


def resolve(href: Column, seed: Column) -> Column:
    """An href that is not absolute becomes ``scheme://netloc`` of the seed
    followed by the href as path (a ``/`` inserted when it lacks one).  ``..``,
    ``//host``, ``mailto:`` and ``?q`` are all taken as paths."""
    prefix = F.concat(scheme_of(seed), F.lit("://"), netloc_of(seed))
    slash = F.when(href.startswith("/"), F.lit("")).otherwise(F.lit("/"))
    return F.when(is_absolute(href), href).otherwise(F.concat(prefix, slash, href))


def same_site(url: Column, seed: Column) -> Column:
    """The URL's network location equals the seed's (port kept)."""
    return netloc_of(url) == netloc_of(seed)


def strip_fragment(url: Column) -> Column:
    """P5: cut at the first ``#``."""
    return F.substring_index(url, "#", 1)


def is_navigation(url: Column, marks: list[str] | None = None) -> Column:
    """Some path segment is a navigation mark (query string not looked at)."""
    marks = NAVIGATION_MARKS if marks is None else marks
    return F.arrays_overlap(F.split(path_of(url), "/"), F.array(*[F.lit(m) for m in marks]))


def host_of(url: Column) -> Column:
    """Host without user info and port."""
    return F.regexp_extract(netloc_of(url), r"^(?:[^@]*@)?([^:]*)", 1)
