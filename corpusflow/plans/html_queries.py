"""HTML field / body-text queries over the stored ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import html as H
from corpusflow.functions import text as T
from corpusflow.functions import urls as U
from corpusflow.operators import html as HP
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import NETLOC_RE, OUT_OF_TEXT, sql_str, unescape_sql
from corpusflow.session import load_table

SELECTORS = [HP.Selector("div.ad", tag="div", cls="ad"), HP.Selector("h1", tag="h1"),
             HP.Selector("li", tag="li")]

# Title markers as the stored pages can hold them (RE2 has no Unicode white space class).
_MARKERS = r"&nbsp;|&#160;|&#32;|&#9248;|&#xA0;|&#x20;|&#x2420;|&#x2423;|&#9251;|[\s\x0B\x1c-\x1f\x85\p{Z}]"
_VIS = f"regexp_replace(html, {sql_str(OUT_OF_TEXT)}, '', 'g')"
_TITLE_SQL = unescape_sql(f"regexp_extract({_VIS}, '(?s)<title>(.*?)</title>', 1)")
_AUTHORS_SQL = "['NOT FOUND']"  # the stored pages name no author

# Body text of flat pages (blocks never nest): block start tags become chr(1),
# everything from a block end tag to the next block start is dropped.
_TEXT_CTE = f"""
_art AS (
  SELECT page_id, regexp_extract({_VIS}, '(?s)<article[^>]*>(.*?)</article>', 1) AS a FROM pages
), _mk AS (
  SELECT page_id,
    regexp_replace(regexp_replace(a, '<(?:h[1-6]|p|li)(?:\\s[^>]*)?>', chr(1), 'g'),
                   '(?s)</(?:h[1-6]|p|li)>.*?(' || chr(1) || '|$)', '\\1', 'g') AS m
  FROM _art
), _pc AS (
  SELECT page_id, l[2:] AS l FROM (SELECT page_id, string_split(m, chr(1)) AS l FROM _mk)
), _pieces AS (
  SELECT page_id, generate_subscripts(l, 1) AS pos, unnest(l) AS piece FROM _pc
), _clean AS (
  SELECT page_id, pos,
    regexp_replace({unescape_sql("regexp_replace(piece, '\\s*<[^>]+>\\s*', '', 'g')")}, '^\\s+|\\s+$', '', 'g') AS t
  FROM _pieces
), page_text AS (
  SELECT p.page_id, coalesce(string_agg(c.t, chr(10) ORDER BY c.pos) FILTER (WHERE c.t <> ''), '') AS text
  FROM pages p LEFT JOIN _clean c ON c.page_id = p.page_id GROUP BY p.page_id
)"""


def pages(spark, sf):
    return load_table(spark, sf, "pages")


@register("page_title", f"SELECT page_id, {_TITLE_SQL} AS title FROM pages")
def q_page_title(spark, sf):
    return pages(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))


def with_head_fields(p):
    """The stored pages with author, date and topic metas derived from their URLs put into the head.

    Entities, quotes of both kinds, a commented-out meta and empty values are among them.
    """
    host = U.netloc_of(F.col("url"))
    n = F.col("page_id")
    day = F.lpad((n % 28 + 1).cast("string"), 2, "0")
    offset = F.when(n % 3 == 0, "+0300").when(n % 3 == 1, "+03:00").otherwise("Z")
    head = F.concat(
        F.lit('<head><!-- <meta name="author" content="Ghost"> -->'),
        F.when(n % 4 == 0, "").otherwise(F.concat(F.lit('<meta name="author" content="'), host, F.lit(' &amp; Co &#8212; &laquo;A&raquo;">'))),
        F.when(n % 5 == 0, '<meta content="" name="author">').otherwise(""),
        F.when(n % 7 == 0, "").otherwise(F.concat(F.lit("<META property='article:published_time' content='2024-03-"), day,
                                                  F.lit("T10:20:30"), offset, F.lit("'>"))),
        F.lit('<meta name="keywords" content="a &gt; b, '), host, F.lit(',, last ">'),
        F.when(n % 2 == 0, '<meta data-x="1>0" property="article:tag" content="even">').otherwise(""))
    return p.withColumn("html", F.concat(head, F.substring_index("html", "<head>", -1)))


_HOST_SQL = f"regexp_extract(url, {sql_str(NETLOC_RE)}, 1)"


@register("page_authors", f"""
SELECT page_id, CAST(to_json(CASE WHEN page_id % 4 = 0 THEN ['NOT FOUND']
                                  ELSE [{_HOST_SQL} || ' & Co — «A»'] END) AS VARCHAR) AS author FROM pages""")
def q_page_authors(spark, sf):
    p = with_head_fields(pages(spark, sf))
    return p.select("page_id", F.to_json(H.page_authors(F.col("html"))).alias("author"))


@register("page_date", """
SELECT page_id, CASE WHEN page_id % 7 <> 0 THEN '2024-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || ' 10:20:30' END AS date
FROM pages""")
def q_page_date(spark, sf):
    from corpusflow.functions.dates import unify_date
    p = with_head_fields(pages(spark, sf))
    d = unify_date(H.page_date_text(F.col("html")))
    return p.select("page_id", F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("date"))


@register("page_topics", f"""
SELECT page_id, CAST(to_json(list_concat(['a > b', {_HOST_SQL}, 'last'], CASE WHEN page_id % 2 = 0 THEN ['even'] ELSE [] END)) AS VARCHAR) AS topics
FROM pages""")
def q_page_topics(spark, sf):
    p = with_head_fields(pages(spark, sf))
    return p.select("page_id", F.to_json(H.page_topics(F.col("html"))).alias("topics"))


@register("parse_head_fields", f"""
SELECT page_id, CAST(to_json(CASE WHEN page_id % 4 = 0 THEN ['NOT FOUND']
                                  ELSE [{_HOST_SQL} || ' & Co — «A»'] END) AS VARCHAR) AS author,
       CASE WHEN page_id % 7 <> 0 THEN '2024-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || ' 10:20:30' END AS date,
       CAST(to_json(list_concat(['a > b', {_HOST_SQL}, 'last'], CASE WHEN page_id % 2 = 0 THEN ['even'] ELSE [] END)) AS VARCHAR) AS topics
FROM pages""")
def q_parse_head_fields(spark, sf):
    parsed = HP.parse_pages(with_head_fields(pages(spark, sf)), article_classes=None)
    return parsed.select("page_id", F.to_json("author").alias("author"),
                         F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), F.to_json("topics").alias("topics"))


@register("page_text", "WITH " + _TEXT_CTE.lstrip() + """
SELECT page_id, text FROM page_text""")
def q_page_text(spark, sf):
    return HP.parse_pages(pages(spark, sf), article_classes=None).select("page_id", "text")


@register("parse_pages", "WITH " + _TEXT_CTE.lstrip() + f"""
SELECT p.page_id, p.url, {_TITLE_SQL} AS title, CAST(to_json({_AUTHORS_SQL}) AS VARCHAR) AS author,
       CAST(NULL AS VARCHAR) AS date, '[]' AS topics, t.text
FROM pages p JOIN page_text t ON t.page_id = p.page_id""")
def q_parse_pages(spark, sf):
    parsed = HP.parse_pages(pages(spark, sf), article_classes=None)
    return parsed.select("page_id", "url", "title", F.to_json("author").alias("author"),
                         F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
                         F.to_json("topics").alias("topics"), "text")


def _select_sql(name: str, regex: str) -> str:
    strip = unescape_sql("regexp_replace(regexp_replace(e, '^<[^>]*>|</[a-z0-9]+>$', '', 'g'), '\\s*<[^>]+>\\s*', '', 'g')")
    return f"""
SELECT page_id, {sql_str(name)} AS selector, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos,
       unnest(l) AS e FROM (SELECT page_id, regexp_extract_all({_VIS}, {sql_str(regex)}) AS l FROM pages)
""", strip


def _html_select_sql() -> str:
    parts = []
    for name, tag, regex in [
        ("div.ad", "div", r"""(?is)<div\b[^>]*\bclass\s*=\s*"(?:[^"]*\s)?ad(?:\s[^"]*)?"[^>]*>.*?</div>"""),
        ("h1", "h1", r"(?is)<h1\b[^>]*>.*?</h1>"),
        ("li", "li", r"(?is)<li\b[^>]*>.*?</li>"),
    ]:
        inner, strip = _select_sql(name, regex)
        parts.append(f"""
SELECT page_id, selector, pos, {sql_str(tag)} AS tag,
  array_to_string(list_filter(regexp_split_to_array(regexp_extract(regexp_extract(e, '^<[^>]*>'), 'class\\s*=\\s*"([^"]*)"', 1), '\\s+'), lambda x: x <> ''), ' ') AS classes,
  regexp_replace({strip}, '^\\s+|\\s+$', '', 'g') AS value
FROM ({inner})""")
    return "\nUNION ALL\n".join(parts)


@register("html_select", _html_select_sql())
def q_html_select(spark, sf):
    return HP.html_select(pages(spark, sf), SELECTORS)


_T6_SQL = """
WITH t AS (
  SELECT page_id, TITLE AS title, html FROM pages
), n AS (
  SELECT page_id, title,
    trim(regexp_replace(title, MARKERS, ' ', 'g'), ' ') AS tn,
    regexp_replace(html, MARKERS, ' ', 'g') AS hn
  FROM t
)
SELECT page_id, title,
  CASE WHEN contains(hn, '&quot;') THEN contains(replace(hn, '&quot;', '"'), replace(tn, '&quot;', '"'))
       WHEN contains(hn, '\\') THEN contains(replace(hn, '\\', ''), replace(tn, '\\', ''))
       ELSE contains(hn, tn) END AS found
FROM n"""


@register("title_in_html", _T6_SQL.replace("TITLE", _TITLE_SQL).replace("MARKERS", sql_str(_MARKERS)))
def q_title_in_html(spark, sf):
    p = pages(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"), "html")
    return p.select("page_id", "title", T.title_in_html(F.col("title"), F.col("html")).alias("found"))


@register("meta_page_checks", "WITH " + _TEXT_CTE.lstrip() + f"""
, meta AS (
  SELECT p.page_id, p.url, {_TITLE_SQL} AS title, {_AUTHORS_SQL} AS author, t.text
  FROM pages p JOIN page_text t ON t.page_id = p.page_id
), j AS (
  SELECT m.page_id, m.url, m.title, m.author, m.text, p.html,
    trim(regexp_replace(m.title, {sql_str(_MARKERS)}, ' ', 'g'), ' ') AS tn,
    regexp_replace(p.html, {sql_str(_MARKERS)}, ' ', 'g') AS hn
  FROM meta m JOIN pages p ON p.page_id = m.page_id
)
SELECT page_id, url,
  CASE WHEN contains(hn, '&quot;') THEN contains(replace(hn, '&quot;', '"'), replace(tn, '&quot;', '"'))
       WHEN contains(hn, '\\') THEN contains(replace(hn, '\\', ''), replace(tn, '\\', ''))
       ELSE contains(hn, tn) END AS title_found,
  (len(list_filter(author, lambda a: NOT contains(html, a))) = 0 OR author = ['NOT FOUND']) AS author_ok,
  text <> '' AS has_text
FROM j""")
def q_meta_page_checks(spark, sf):
    checked = HP.meta_page_checks(HP.parse_pages(pages(spark, sf), article_classes=None, keep_html=True))
    return checked.select("page_id", "url", "title_found", "author_ok", "has_text")


@register("meta_field_checks", """
SELECT page_id, true AS author_ok, page_id % 7 <> 0 AS date_ok, false AS topics_ok FROM pages""")
def q_meta_field_checks(spark, sf):
    # The author as it is read is not in the page (its entities are), but the NOT FOUND mark is let pass;
    # "a > b" stands in the page as an entity only.
    p = with_head_fields(pages(spark, sf)).withColumn("html", F.concat("html", F.lit("<!--"), U.netloc_of(F.col("url")), F.lit(" & Co — «A»-->")))
    checked = HP.meta_page_checks(HP.parse_pages(p, article_classes=None, keep_html=True))
    return checked.select("page_id", "author_ok", "date_ok", "topics_ok")


@register("article_records", "WITH " + _TEXT_CTE.lstrip() + f"""
SELECT CAST(row_number() OVER (ORDER BY p.page_id) AS BIGINT) AS article_id, p.url, {_TITLE_SQL} AS title,
       CAST(to_json({_AUTHORS_SQL}) AS VARCHAR) AS author, t.text
FROM pages p JOIN page_text t ON t.page_id = p.page_id
WHERE p.html IS NOT NULL AND p.html <> ''""")
def q_article_records(spark, sf):
    # E1 tail: parse every fetched page (P16), then number the articles 1..N
    # in discovery order (W1) without a single-partition window.
    from corpusflow.operators.links import assign_ids
    # Only the page ids are sorted and numbered; each page is parsed once.
    p = pages(spark, sf).filter(F.col("html").isNotNull() & (F.col("html") != ""))
    ids = assign_ids(p.select("page_id"), ["page_id"])
    arts = HP.parse_pages(p, article_classes=None).join(ids, on="page_id")
    return arts.select("article_id", "url", "title", F.to_json("author").alias("author"), "text")
