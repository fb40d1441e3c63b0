"""Link / URL queries over the stored ``pages`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import urls as U
from corpusflow.operators import links as L
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import NETLOC_RE, PATH_RE, SCHEME_RE, links_cte, sql_str
from corpusflow.session import load_table

# Navigation marks that do occur in the generated pages (their hrefs are
# single words), so that both link kinds show up.
TEST_MARKS = ["the", "de", "in"]
ARTICLE_CAP = 100
SAMPLE_K = 10


def pages(spark, sf):
    return load_table(spark, sf, "pages")


@register("extract_links", "WITH " + links_cte().lstrip() + """
SELECT page_id, pos, href FROM hrefs WHERE href <> ''""")
def q_extract_links(spark, sf):
    return L.extract_links(pages(spark, sf), keep=()).select("page_id", "pos", "href")


@register("is_absolute_url", "WITH " + links_cte().lstrip() + """
SELECT page_id, pos, href AS value, regexp_matches(href, '^https?://') AS is_absolute
FROM hrefs WHERE href <> ''
UNION ALL
SELECT page_id, -1 AS pos, url AS value, regexp_matches(url, '^https?://') AS is_absolute FROM pages""")
def q_is_absolute_url(spark, sf):
    p = pages(spark, sf)
    h = L.extract_links(p, keep=()).select("page_id", "pos", F.col("href").alias("value"))
    u = p.select("page_id", F.lit(-1).alias("pos"), F.col("url").alias("value"))
    both = h.unionByName(u)
    return both.withColumn("is_absolute", U.is_absolute(F.col("value")))


@register("resolve_links", "WITH " + links_cte().lstrip() + """
SELECT page_id, pos, href, url FROM links""")
def q_resolve_links(spark, sf):
    links = L.resolve_links(L.extract_links(pages(spark, sf)))
    return links.select("page_id", "pos", "href", F.col("url_nofrag").alias("url"))


@register("same_site_links", "WITH " + links_cte().lstrip() + f"""
, cand AS (
  SELECT page_id, pos, seed, link_url AS candidate FROM links
  UNION ALL
  SELECT p.page_id, -1 AS pos, p.url AS seed, q.url AS candidate
  FROM pages p JOIN pages q ON q.page_id = p.page_id + 1
)
SELECT page_id, pos, candidate,
  regexp_extract(candidate, {sql_str(NETLOC_RE)}, 1) = regexp_extract(seed, {sql_str(NETLOC_RE)}, 1) AS same_site
FROM cand""")
def q_same_site_links(spark, sf):
    p = pages(spark, sf)
    links = L.resolve_links(L.extract_links(p)).select(
        "page_id", "pos", F.col("url").alias("seed"), F.col("link_url").alias("candidate"))
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("candidate"))
    neighbours = p.select("page_id", F.col("url").alias("seed")).join(nxt, on="page_id").select(
        "page_id", F.lit(-1).alias("pos"), "seed", "candidate")
    cand = links.unionByName(neighbours)
    return cand.select("page_id", "pos", "candidate",
                       U.same_site(F.col("candidate"), F.col("seed")).alias("same_site"))


@register("strip_fragment", """
SELECT page_id, split_part(url, '#', 1) AS url FROM pages WHERE split_part(url, '#', 1) <> ''""")
def q_strip_fragment(spark, sf):
    p = pages(spark, sf).select("page_id", U.strip_fragment(F.col("url")).alias("url"))
    return p.filter(F.col("url") != "")


@register("classify_links", "WITH " + links_cte(TEST_MARKS).lstrip() + """
SELECT page_id, pos, url, kind FROM classified""")
def q_classify_links(spark, sf):
    return L.classified_links(pages(spark, sf), TEST_MARKS).select("page_id", "pos", "url", "kind")


@register("valid_seed_urls", """
SELECT page_id, url, regexp_matches(url, '^https?://') AS valid FROM pages""")
def q_valid_seed_urls(spark, sf):
    return pages(spark, sf).select("page_id", "url", U.is_absolute(F.col("url")).alias("valid"))


@register("url_pattern_filter", """
SELECT page_id, url FROM pages WHERE regexp_matches(url, '/en/[0-9]+')""")
def q_url_pattern_filter(spark, sf):
    return pages(spark, sf).filter(F.col("url").rlike(r"/en/[0-9]+")).select("page_id", "url")


@register("url_parts", f"""
SELECT page_id,
  lower(regexp_extract(url, {sql_str(SCHEME_RE)}, 1)) AS scheme,
  regexp_extract(url, {sql_str(NETLOC_RE)}, 1) AS netloc,
  regexp_replace(regexp_extract(url, {sql_str(PATH_RE)}, 1), ';[^/]*$', '') AS path,
  regexp_extract(regexp_extract(url, {sql_str(PATH_RE)}, 1), ';([^/]*)$', 1) AS params,
  regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query,
  regexp_extract(url, '#(.*)$', 1) AS fragment
FROM pages""")
def q_url_parts(spark, sf):
    u = F.col("url")
    return pages(spark, sf).select(
        "page_id", U.scheme_of(u).alias("scheme"), U.netloc_of(u).alias("netloc"),
        U.path_of(u).alias("path"), U.params_of(u).alias("params"),
        U.query_of(u).alias("query"), U.fragment_of(u).alias("fragment"))


@register("unvisited_urls", "WITH " + links_cte().lstrip() + """
SELECT DISTINCT url FROM classified
WHERE url NOT IN (SELECT url FROM pages)""")
def q_unvisited_urls(spark, sf):
    p = pages(spark, sf)
    urls = L.classified_links(p).select("url").distinct()
    return urls.join(p.select("url"), on="url", how="left_anti")


_NEW_ARTICLES = """
, arts AS (
  SELECT c.url, c.page_id AS seed_order, c.pos FROM classified c
  WHERE c.kind = 'article' AND NOT EXISTS (SELECT 1 FROM pages s WHERE s.url = c.url)
), firsts AS (
  SELECT url, seed_order, pos FROM (
    SELECT url, seed_order, pos, row_number() OVER (PARTITION BY url ORDER BY seed_order, pos) AS rn
    FROM arts) WHERE rn = 1
)"""


@register("new_article_urls", "WITH " + links_cte().lstrip() + _NEW_ARTICLES + """
SELECT url, seed_order, pos FROM firsts""")
def q_new_article_urls(spark, sf):
    return L.find_articles(pages(spark, sf))


@register("find_articles", "WITH " + links_cte(TEST_MARKS).lstrip() + _NEW_ARTICLES + """
SELECT url, seed_order, pos FROM firsts""")
def q_find_articles(spark, sf):
    p = pages(spark, sf)
    seeds = p.select("url", F.col("page_id").alias("seed_order"))
    return L.find_articles(p, seeds, marks=TEST_MARKS)


@register("cap_articles", "WITH " + links_cte().lstrip() + _NEW_ARTICLES + f"""
SELECT url, seed_order, pos FROM firsts ORDER BY seed_order, pos LIMIT {ARTICLE_CAP}""")
def q_cap_articles(spark, sf):
    return L.cap_rows(L.find_articles(pages(spark, sf)), ["seed_order", "pos"], ARTICLE_CAP)


@register("first_seen_urls", "WITH " + links_cte().lstrip() + """
SELECT url, page_id, pos, kind FROM (
  SELECT url, page_id, pos, kind, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn
  FROM classified) WHERE rn = 1""")
def q_first_seen_urls(spark, sf):
    links = L.classified_links(pages(spark, sf)).select("url", "page_id", "pos", "kind")
    return L.first_seen(links, "url", ["page_id", "pos"])


@register("assign_article_ids", """
SELECT page_id, url, row_number() OVER (ORDER BY page_id) AS article_id
FROM pages WHERE html IS NOT NULL AND html <> ''""")
def q_assign_article_ids(spark, sf):
    ok = pages(spark, sf).filter(F.col("html").isNotNull() & (F.col("html") != ""))
    return L.assign_ids(ok.select("page_id", "url"), ["page_id"], key=["page_id"])


@register("sample_articles", f"""
SELECT page_id, url FROM pages ORDER BY md5(url), url LIMIT {SAMPLE_K}""")
def q_sample_articles(spark, sf):
    return L.sample_rows(pages(spark, sf).select("page_id", "url"), "url", SAMPLE_K)


@register("frontier_union", "WITH " + links_cte(TEST_MARKS).lstrip() + """
SELECT url FROM classified WHERE kind = 'article'
UNION
SELECT url FROM classified WHERE kind = 'navigation'""")
def q_frontier_union(spark, sf):
    c = L.classified_links(pages(spark, sf), TEST_MARKS)
    arts = c.filter(F.col("kind") == "article").select("url")
    nav = c.filter(F.col("kind") == "navigation").select("url")
    return arts.union(nav).distinct()


@register("frontier_except", "WITH " + links_cte(TEST_MARKS).lstrip() + """
SELECT url FROM classified
EXCEPT
SELECT split_part(url, '#', 1) AS url FROM pages""")
def q_frontier_except(spark, sf):
    p = pages(spark, sf)
    c = L.classified_links(p, TEST_MARKS).select("url")
    visited = p.select(U.strip_fragment(F.col("url")).alias("url"))
    return c.subtract(visited)


@register("duplicate_urls", "WITH " + links_cte().lstrip() + """
SELECT url, count(*) AS n FROM links GROUP BY url HAVING count(*) > 1""")
def q_duplicate_urls(spark, sf):
    links = L.resolve_links(L.extract_links(pages(spark, sf)))
    return (links.groupBy(F.col("url_nofrag").alias("url")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


@register("distinct_urls", "WITH " + links_cte().lstrip() + """
SELECT DISTINCT url FROM links""")
def q_distinct_urls(spark, sf):
    links = L.resolve_links(L.extract_links(pages(spark, sf)))
    return links.select(F.col("url_nofrag").alias("url")).dropDuplicates(["url"])


@register("collected_counts", "WITH " + links_cte().lstrip() + f"""
, per_page AS (
  SELECT p.page_id, regexp_extract(p.url, {sql_str(NETLOC_RE)}, 1) AS host,
         (SELECT count(*) FROM classified c WHERE c.page_id = p.page_id AND c.kind = 'article') AS n_links
  FROM pages p
)
SELECT host, count(*) AS n_pages, CAST(sum(n_links) AS BIGINT) AS n_article_links FROM per_page GROUP BY host""")
def q_collected_counts(spark, sf):
    p = pages(spark, sf)
    per_page_links = (L.classified_links(p).filter(F.col("kind") == "article")
                      .groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links")))
    per_page = p.select("page_id", U.netloc_of(F.col("url")).alias("host")).join(
        per_page_links, on="page_id", how="left")
    return per_page.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.coalesce(F.sum("n_links"), F.lit(0)).cast("bigint").alias("n_article_links"))


@register("fetch_pages", "WITH " + links_cte().lstrip() + """
, wanted AS (SELECT url FROM pages UNION SELECT url FROM links)
SELECT p.page_id, p.url FROM wanted w JOIN pages p ON p.url = w.url""")
def q_fetch_pages(spark, sf):
    p = pages(spark, sf)
    link_urls = L.resolve_links(L.extract_links(p)).select(F.col("url_nofrag").alias("url"))
    wanted = p.select("url").union(link_urls).distinct()
    return L.fetch_pages(wanted, p.select("page_id", "url", "html")).select("page_id", "url")
