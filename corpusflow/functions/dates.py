"""Date column functions.

Unparsable text gives null (``try_`` parsing) instead of an exception.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
META_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"          # %Y-%m-%d %H:%M:%S
META_DATE_REGEX = r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"     # %Y-%m-%dT%H:%M:%S%z
CUSTOM_FORMAT = "yyyy.MM.dd HH:mm:ss"
REPORT_NAME_REGEX = r"report_(\d{4}-\d{2}-\d{2})\.txt"
# ---------------------------------------------------------------------------


# %Y-%m-%d %H:%M:%S as strptime reads it (one or two digits per field).
_META_PARTS = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"


def _to_ntz(text: Column) -> Column:
    """Wall-clock parse without any time zone; invalid dates give null."""
    parts = [F.regexp_extract(text, _META_PARTS, i).try_cast("int") for i in range(1, 7)]
    ok = text.rlike(_META_PARTS)
    return F.when(ok, F.try_make_timestamp_ntz(*parts))


def date_from_meta(text: Column, default: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ; empty/null -> ``default``."""
    parsed = _to_ntz(text)
    fallback = default if default is not None else F.lit(None).cast("timestamp_ntz")
    return F.when(text.isNull() | (text == ""), fallback).otherwise(parsed)


def date_to_text(ts: Column) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss``; null -> ``""``."""
    return F.coalesce(F.date_format(ts, META_DATE_FORMAT), F.lit(""))


def looks_like_meta_date(text: Column) -> Column:
    """Holds a ``dddd-dd-dd dd:dd:dd`` date somewhere."""
    return text.rlike(META_DATE_REGEX)


def unify_date(text: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss+hh:mm`` -> TIMESTAMP_NTZ keeping the wall clock
    (the offset is dropped, as writing the meta date drops it)."""
    ok = text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(Z|[+-]\d\d:?\d\d)$")
    return F.when(ok, _to_ntz(F.regexp_replace(F.substring(text, 1, 19), "T", " ")))


def site_date(text: Column, fmt: str) -> Column:
    """A date in a site's own format -> TIMESTAMP_NTZ; what doesn't parse gives null."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def unify_date_instant(text: Column) -> Column:
    """X4, instant variant: the offset applied (a TIMESTAMP)."""
    with_colon = F.regexp_replace(text, r"([+-]\d\d)(\d\d)$", "$1:$2")
    return F.try_to_timestamp(with_colon, F.lit(ISO_OFFSET_FORMAT))


def custom_format(ts: Column) -> Column:
    """``yyyy.MM.dd HH:mm:ss``."""
    return F.date_format(ts, CUSTOM_FORMAT)


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end`` rounded half-up to one decimal
    (integer arithmetic on microseconds, so engines agree exactly)."""
    x = F.timestamp_diff("MICROSECOND", start, end) + F.lit(180_000_000)
    tenths = (x - F.pmod(x, F.lit(360_000_000))) / F.lit(360_000_000)
    return tenths.cast("double") / F.lit(10.0)


def date_from_report_name(name: Column) -> Column:
    """The date in ``report_YYYY-MM-DD.txt``."""
    return F.try_to_date(F.regexp_extract(name, REPORT_NAME_REGEX, 1), "yyyy-MM-dd")
