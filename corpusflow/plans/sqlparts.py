"""Shared DuckDB SQL fragments for the oracle queries.

DuckDB's regex engine (RE2) has no look-around, so the sentence boundary rule
is rewritten as marker replacements: protected spaces become chr(2), split
points chr(1).
"""

from __future__ import annotations

from corpusflow.functions.text import LATIN_LOWER, LATIN_UPPER, PUNCTUATION, TOKEN_REGEX
from corpusflow.operators.annotate import LEXICON


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sentences_cte(upper: str = LATIN_UPPER, lower: str = LATIN_LOWER) -> str:
    """CTE ``sents(article_id, lang, sent_id, sentence)`` over ``documents``."""
    return f"""
_norm AS (
  SELECT doc_id + 1 AS article_id, lang,
         regexp_replace(text, '[\\n|\\t]+', '. ', 'g') AS t
  FROM documents
), _mark AS (
  SELECT article_id, lang,
    regexp_replace(
      regexp_replace(
        regexp_replace(t, '([{upper}][{lower}]\\.)\\s', '\\1' || chr(2), 'g'),
        '([\\p{{L}}\\p{{N}}_]\\.[\\p{{L}}\\p{{N}}_].)\\s', '\\1' || chr(2), 'g'),
      '([.?!]|[?!]")\\s([{upper}])', '\\1' || chr(1) || '\\2', 'g') AS t
  FROM _norm
), _lists AS (
  SELECT article_id, lang,
    list_filter(
      list_transform(string_split(t, chr(1)), lambda x: replace(x, chr(2), ' ')),
      lambda x: length(replace(x, ' ', '')) > 0 AND length(x) > 10) AS l
  FROM _mark
), sents AS MATERIALIZED (
  SELECT article_id, lang, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS sent_id,
         unnest(l) AS sentence
  FROM _lists
)"""


def lexicon_values() -> str:
    rows = ", ".join(f"({sql_str(a)}, {sql_str(b)}, {sql_str(c)})" for a, b, c in LEXICON)
    return f"(VALUES {rows}) AS lex(lang, form_lc, lex_upos)"


def tokens_cte() -> str:
    """CTE ``tokens`` (TOKEN schema) after ``sents``: the rule annotator."""
    return f"""
, _toklist AS (
  SELECT article_id, sent_id, lang, regexp_extract_all(sentence, {sql_str(TOKEN_REGEX)}) AS l
  FROM sents
), _tok AS (
  SELECT article_id, sent_id, lang, CAST(generate_subscripts(l, 1) AS INTEGER) AS id,
         unnest(l) AS form
  FROM _toklist
), tokens AS MATERIALIZED (
  SELECT t.article_id, t.sent_id, t.id, t.form, lower(t.form) AS lemma,
    CASE WHEN NOT regexp_matches(t.form, '[\\p{{L}}\\p{{N}}]') THEN 'PUNCT'
         WHEN regexp_matches(t.form, '^\\p{{N}}+$') THEN 'NUM'
         WHEN lex.lex_upos IS NOT NULL THEN lex.lex_upos
         WHEN regexp_matches(t.form, '^\\p{{Lu}}') AND t.id > 1 THEN 'PROPN'
         ELSE 'NOUN' END AS upos,
    '_' AS xpos,
    CASE WHEN NOT regexp_matches(t.form, '[\\p{{L}}\\p{{N}}]') OR regexp_matches(t.form, '^\\p{{N}}+$') THEN '_'
         WHEN regexp_matches(t.form, '^\\p{{Lu}}') THEN 'Case=Up' ELSE 'Case=Low' END AS feats,
    CAST(t.id - 1 AS INTEGER) AS head,
    CASE WHEN t.id = 1 THEN 'ROOT' ELSE 'dep' END AS deprel,
    '_' AS deps, '_' AS misc
  FROM _tok t LEFT JOIN {lexicon_values()} ON lex.lang = t.lang AND lex.form_lc = lower(t.form)
)"""


def token_sql() -> str:
    """``WITH sents ..., tokens ...`` prefix for oracle queries over rule tokens."""
    return "WITH " + sentences_cte().lstrip() + tokens_cte()


PUNCT_SQL = sql_str(PUNCTUATION)


def unescape_sql(expr: str) -> str:
    """The entities that the stored pages hold; ``&amp`` also without its semicolon."""
    for ent, ch in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        expr = f"replace({expr}, {sql_str(ent)}, {sql_str(ch)})"
    return f"regexp_replace({expr}, '&amp;?', '&', 'g')"


# What the stored pages hold besides content, and how they write their links.
OUT_OF_TEXT = "(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->"
PLAIN_ANCHOR = '<a href="([^"]*)">'


NETLOC_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
SCHEME_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"


def links_cte(marks: list[str] | None = None) -> str:
    """CTEs ``hrefs(page_id, seed, pos, href)``, ``links(..., link_url, url,
    same_site)`` and ``classified(page_id, seed, pos, href, url, kind)``."""
    from corpusflow.functions.urls import NAVIGATION_MARKS
    marks = NAVIGATION_MARKS if marks is None else marks
    mark_list = "[" + ", ".join(sql_str(m) for m in marks) + "]"
    href = unescape_sql("regexp_replace(raw, '^[\"'']|[\"'']$', '', 'g')")
    return f"""
_vis AS (
  SELECT page_id, url AS seed, regexp_replace(html, {sql_str(OUT_OF_TEXT)}, '', 'g') AS h FROM pages
), _raw AS (
  SELECT page_id, seed, regexp_extract_all(h, {sql_str(PLAIN_ANCHOR)}, 1) AS l FROM _vis
), _hr AS (
  SELECT page_id, seed, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS raw FROM _raw
), hrefs AS (
  SELECT page_id, seed, pos, {href} AS href FROM _hr
), _res AS (
  SELECT page_id, seed, pos, href,
    CASE WHEN regexp_matches(href, '^https?://') THEN href
         ELSE lower(regexp_extract(seed, {sql_str(SCHEME_RE)}, 1)) || '://' || regexp_extract(seed, {sql_str(NETLOC_RE)}, 1)
              || CASE WHEN starts_with(href, '/') THEN '' ELSE '/' END || href END AS link_url
  FROM hrefs WHERE href <> ''
), links AS (
  SELECT page_id, seed, pos, href, link_url, split_part(link_url, '#', 1) AS url,
         regexp_extract(link_url, {sql_str(NETLOC_RE)}, 1) = regexp_extract(seed, {sql_str(NETLOC_RE)}, 1) AS same_site
  FROM _res
), classified AS (
  SELECT page_id, seed, pos, href, url,
    CASE WHEN list_has_any(string_split(regexp_replace(regexp_extract(url, {sql_str(PATH_RE)}, 1), ';[^/]*$', ''), '/'),
                           {mark_list}) THEN 'navigation' ELSE 'article' END AS kind
  FROM links WHERE same_site AND url <> ''
)"""
