"""Text column functions: cleaning, sentence split, tokens, lint and title checks.

All functions return Spark ``Column`` expressions, so they run inside
whole-stage code generation on the executors.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The 32 ASCII punctuation characters (Python's ``string.punctuation``), in
# their natural order.  Cleaning deletes exactly these characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Default letter classes of the sentence splitter (Cyrillic capitals / small
# letters), and a Latin-1 pair for Western European text.
CYRILLIC_UPPER, CYRILLIC_LOWER = "А-Я", "а-я"
LATIN_UPPER, LATIN_LOWER = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"

# Title normalisation markers: no-break / space entities and whitespace.
TITLE_SPLIT_MARKERS = (
    r"(?U)&nbsp;|&#160;|&#32;|&#9248;|&#xA0;|&#x20;|&#x2420;|&#x2423;|&#9251;|\s"
)
# ---------------------------------------------------------------------------

# Token of the rule annotator: a run of letters / marks / digits / underscore,
# or any single other non-space character.  Whitespace is spelled out so that
# Java and RE2 agree on it.
TOKEN_REGEX = r"[\p{L}\p{M}\p{N}_]+|[^\s\x0B\p{Z}\p{L}\p{M}\p{N}_]"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Lowercase, then delete every ASCII punctuation character."""
    return F.translate(F.lower(col_of(text)), PUNCTUATION, "")


def sentence_split_regex(upper: str = CYRILLIC_UPPER, lower: str = CYRILLIC_LOWER) -> str:
    """T2 boundary: whitespace after ``. ? ! ?" !"`` and before a capital.

    Not a boundary after ``x.y.``-like groups or a ``Xx.`` abbreviation.
    ``(?U)`` gives Unicode ``\\w``/``\\s``; ``(?d)`` keeps only ``\\n`` as the
    line terminator for ``.``.
    """
    return (
        r"(?Ud)(?<!\w\.\w.)(?<![" + upper + "][" + lower + r"]\.)"
        r"((?<=\.|\?|!)|(?<=\?\"|!\"))\s(?=[" + upper + "])"
    )


def normalize_breaks(text: Column | str) -> Column:
    """Runs of newline / tab / ``|`` become ``". "`` before splitting."""
    return F.regexp_replace(col_of(text), r"[\n|\t]+", ". ")


def split_sentences(text: Column | str, upper: str = CYRILLIC_UPPER,
                    lower: str = CYRILLIC_LOWER) -> Column:
    """Array of sentences; pieces must be longer than 10 characters and
    hold something besides spaces."""
    pieces = F.split(normalize_breaks(text), sentence_split_regex(upper, lower))
    return F.filter(
        pieces,
        lambda s: (F.length(F.replace(s, F.lit(" "), F.lit(""))) > 0) & (F.length(s) > 10),
    )


def whitespace_tokens(text: Column | str) -> Column:
    """Whitespace-separated tokens, empty pieces dropped."""
    return F.filter(F.split(col_of(text), r"\s+"), lambda t: t != "")


def rule_tokens(sentence: Column | str) -> Column:
    """Tokens of the rule annotator (see ``operators.annotate``)."""
    return F.regexp_extract_all(col_of(sentence), F.lit(TOKEN_REGEX), 0)


def punct_class_regex() -> str:
    """A regex character class holding exactly the 32 ASCII punctuation chars."""
    escaped = "".join("\\" + ch for ch in PUNCTUATION)
    return "[" + escaped + "]"


def has_punctuation(text: Column | str) -> Column:
    """Text holds at least one ASCII punctuation character."""
    return col_of(text).rlike(punct_class_regex())


def is_short_text(text: Column | str, min_len: int = 5) -> Column:
    """T5: a text of ``min_len`` characters or fewer is bad."""
    return F.length(col_of(text)) <= min_len


def normalize_title_markers(c: Column) -> Column:
    """T6 helper: every split marker becomes one space (runs are not collapsed)."""
    return F.regexp_replace(c, TITLE_SPLIT_MARKERS, " ")


def title_in_html(title: Column | str, html: Column | str) -> Column:
    """Is the normalised title a substring of the normalised page?

    Markers turn into single spaces and the title is trimmed; if the page holds
    ``&quot;`` both sides have it unescaped, else if the page holds a backslash
    it is deleted from both sides.
    """
    t = F.trim(normalize_title_markers(col_of(title)), F.lit(" "))
    h = normalize_title_markers(col_of(html))
    has_quot = h.contains("&quot;")
    has_backslash = h.contains("\\")
    t2 = (F.when(has_quot, F.replace(t, F.lit("&quot;"), F.lit('"')))
          .when(has_backslash, F.replace(t, F.lit("\\"), F.lit("")))
          .otherwise(t))
    h2 = (F.when(has_quot, F.replace(h, F.lit("&quot;"), F.lit('"')))
          .when(has_backslash, F.replace(h, F.lit("\\"), F.lit("")))
          .otherwise(h))
    return F.contains(h2, t2)


_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)|[^&]+|&"


def _literal(value: object) -> str:
    """The JSON text of ``value`` as an SQL literal."""
    return "'" + json.dumps(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number_sql(digits: str, base: int) -> str:
    """Character of a numeric reference; 0x80-0x9f stand for the Windows-1252 characters (undefined ones stay)."""
    windows = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    number = f"cast(conv(CASE WHEN length(ltrim('0', {digits})) > 8 THEN '99999999' ELSE {digits} END, {base}, 10) AS bigint)"
    return f"""transform(array({number}), n -> CASE
        WHEN n = 13 THEN chr(13)
        WHEN n = 0 OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN decode(unhex('EFBFBD'), 'UTF-8')
        WHEN n BETWEEN 128 AND 159 THEN try_element_at(from_json({_literal(windows)}, 'map<string,string>'), cast(n AS string))
        WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR (n & 65534) = 65534 THEN ''
        ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END)[0]"""


def _entity_sql() -> str:
    """The text of one token t of ``_ENTITY``: what an entity stands for, or the token itself.

    All names are one constant map by first letter, which Spark reads once per plan.  Some
    names hold without a semicolon: of these the longest that the token starts with counts.
    """
    names: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        names.setdefault(name[0], {})[name] = text
    own = f"try_element_at(from_json({_literal(names)}, 'map<string,map<string,string>>'), substr(t, 2, 1))"
    bare = sorted({len(k) for k in html5 if not k.endswith(";")}, reverse=True)
    starts = ", ".join(f"concat(try_element_at(o, substr(t, 2, {n})), substr(t, {n + 2}))" for n in bare)
    body = "trim(TRAILING ';' FROM t)"
    return f"""t -> CASE
        WHEN t RLIKE '^&#[xX]' THEN {_number_sql(f"substr({body}, 4)", 16)}
        WHEN startswith(t, '&#') THEN {_number_sql(f"substr({body}, 3)", 10)}
        WHEN startswith(t, '&') THEN transform(array({own}), o -> coalesce(try_element_at(o, substr(t, 2)), {starts}, t))[0]
        ELSE t END"""


_ENTITY_SQL = _entity_sql()


def unescape_html(c: Column) -> Column:
    """Every named and numeric entity resolved once, as HTML parsers do."""
    tokens = F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0))
    return F.when(c.contains("&"), F.array_join(F.call_function("transform", tokens, F.expr(_ENTITY_SQL)), "")).otherwise(c)
