"""Cases that earlier versions got wrong."""

import datetime as dt
import html as pyhtml
import json
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.functions import html as FH
from corpusflow.functions import text as T
from corpusflow.operators import annotate as A
from corpusflow.operators import crawl as C
from corpusflow.operators import graph as G
from corpusflow.operators import html as H
from corpusflow.operators import links as L
from corpusflow.operators.site import SiteRules
from corpusflow.sinks import files as K


def test_ids_of_a_large_frame_with_a_payload(spark):
    n = 2_000_000
    df = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))
    path = tempfile.mkdtemp(prefix="ids-") + "/t"
    L.assign_ids(df, ["k"], num_partitions=8).write.parquet(path)
    got = spark.read.parquet(path).agg(F.countDistinct("article_id"), F.min("article_id"), F.max("article_id"),
                                       F.sum((F.col("article_id") != F.col("k") + 1).cast("int"))).first()
    assert tuple(got) == (n, 1, n, 0)


def test_ids_by_key_join_the_payload_back(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "k long, payload string").repartition(5)
    got = L.assign_ids(df, ["k"], key=["k"]).collect()
    assert sorted((r.k, r.payload, r.article_id) for r in got) == [(i, f"p{i}", i + 1) for i in range(50)]


def _ladder(n):
    rows = [("s", "a0"), ("s", "b0")]
    for i in range(n - 1):
        rows += [(x + str(i), y + str(i + 1)) for x in "ab" for y in "ab"]
    return rows


def test_deep_graph_with_fan_in(spark):
    links = spark.createDataFrame(_ladder(80), "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    got = {r.url: r.depth for r in C.bfs_levels(links, seeds).collect()}
    assert len(got) == 161 and got["a79"] == got["b79"] == 80
    with pytest.raises(RuntimeError):
        C.bfs_levels(links, seeds, max_rounds=5)


def _maker(word):
    def factory():
        return lambda texts: [word for _ in texts]
    return factory


def test_two_analyzers_of_one_maker(spark):
    docs = spark.createDataFrame([(1, "x")], "article_id long, text string")
    assert [A.annotate_with(docs, _maker(w)).first().conllu for w in ("AAA", "BBB", "AAA")] == ["AAA", "BBB", "AAA"]


def test_href_of_the_right_attribute(spark):
    body = """<a data-href="/x" href="/y">1</a> <a title="a > b" href='/z'>2</a> <a href="/q?a=1&#38;b=2">3</a> <A HREF=/u class=c>4</A>
        <a hreflang="en" href = "/v">5</a> <a title=' href="/no" ' href="/w">6</a> <abbr href="/no">7</abbr> <a name="n">8</a> <a href>9</a><a
        class="k"
        href="/t&eacute;">10</a><a href="">11</a>"""
    df = spark.createDataFrame([(1, "https://h/", body)], "page_id long, url string, html string")
    assert [r.href for r in L.extract_links(df).orderBy("pos").collect()] == ["/y", "/z", "/q?a=1&b=2", "/u", "/v", "/w", "/té"]


def _unescape(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(T.unescape_html(F.col("v"))).collect()]


def test_entities(spark):
    values = ["&mdash;&#8212;&laquo;A&raquo;", "&amp;quot;", "&amp", "a&ampb", "&notit;", "&notin;", "&unknown;", "&", "&;", "&#;", "&#x;", "&#0;", "&#x80;",
              "&#xD800;", "&#1114112;", "&#99999999999;", "&#x1F600;", "&#13;", "&#1;", "x&copy y", "&nbsp;", "&#38;#38;", "&#0065;", "none"]
    assert _unescape(spark, values) == [pyhtml.unescape(v) for v in values]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["&", "amp", ";", "#", "x", "41", "8212", "eacute", "not", "lt", " ", "é", "&#", "&#x"]), max_size=8).map("".join),
                min_size=1, max_size=12))
def test_entities_as_the_parser_has_them(spark, values):
    assert _unescape(spark, values) == [pyhtml.unescape(v) for v in values]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from([
    '<meta name="author" content="A &amp; B">', "<meta content='&laquo;C&raquo;' name='author'>", '<!-- <meta name="author" content="Ghost"> -->',
    '<meta name="author" content="">', '<meta data-x="1>0" name="author" content="D">', '<script>"<meta name=\'author\' content=\'no\'>"</script>',
    '<meta name="keywords" content="a, b &gt; c,,">', '<meta property="article:tag" content="t">',
    '<meta property="article:published_time" content="2024-05-06T07:08:09+0300">', "<title>x &mdash; y &#8212;</title>", "<title>second</title>"]), max_size=8))
def test_head_fields_as_the_parser_has_them(spark, parts):
    page = "<html><head>" + "".join(parts) + "</head><body><p>x</p></body></html>"
    p = H.parse_html(page)
    got = spark.createDataFrame([(page,)], "html string").select(
        FH.page_title(F.col("html")), FH.page_authors(F.col("html")), FH.page_date_text(F.col("html")), FH.page_topics(F.col("html"))).first()
    assert tuple(got) == (p.title(), p.authors(), p.published(), p.topics())


def test_plans_start_no_job(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    seeds = pages.select("url", F.col("page_id").alias("seed_order"))
    L.find_articles(pages, seeds)
    L.classified_links(pages)
    H.parse_pages(pages)
    A.annotate_rules(A.sentences(pages.select(F.col("page_id").alias("article_id"), F.col("html").alias("text"), F.lit("en").alias("lang")), keep=("lang",)))
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_url_is_fetched_once_and_only_if_it_answers(spark):
    pages = spark.createDataFrame([(3, "u", "third", 200), (1, "u", "first", 500), (2, "u", "second", 200), (4, "v", "gone", 404)],
                                  "page_id long, url string, html string, status int")
    urls = spark.createDataFrame([("u",), ("v",), ("w",)], "url string")
    assert [(r.url, r.page_id, r.html) for r in L.fetch_pages(urls, pages).collect()] == [("u", 2, "second")]


def test_meta_json_is_nested_and_updates_keep_the_rest(spark):
    articles = spark.createDataFrame([(1, "t", '{"0":[]}'), (2, "u", None), (3, "v", "no json")], "article_id long, title string, pattern_matches string")
    path = tempfile.mkdtemp(prefix="meta-") + "/m"
    K.write_meta(articles, path)
    raw = sorted(json.loads(r.value)["pattern_matches"] is None or json.loads(r.value)["pattern_matches"] == {"0": []} for r in spark.read.text(path).collect())
    assert raw == [True] * 3
    counts = spark.createDataFrame([(1, {"NOUN": 2})], "article_id long, pos_frequencies map<string,long>")
    meta = {r.id: r for r in K.update_meta(K.read_meta(spark, path), counts=counts).collect()}
    assert meta[1].pos_frequencies == {"NOUN": 2} and json.loads(meta[1].pattern_matches) == {"0": []}
    assert meta[2].pos_frequencies == {} and meta[2].pattern_matches is None
    found = spark.createDataFrame([(2, {"1": ["x"]})], "article_id long, pattern_matches map<string,array<string>>")
    later = {r.id: r.pattern_matches for r in K.update_meta(K.read_meta(spark, path), matches=found).collect()}
    assert json.loads(later[1]) == {"0": []} and json.loads(later[2]) == {"1": ["x"]}


def test_site_rules_are_all_used(spark):
    page = """<html><head><meta property="article:published_time" content="06.05.2024 07:08"></head><body>
        <article class="mine"><blockquote>quoted</blockquote><p>plain</p><p class="ad">ad</p></article></body></html>"""
    df = spark.createDataFrame([(1, "https://s/", page)], "page_id long, url string, html string")
    rules = SiteRules(article_classes=("mine",), block_tags=("blockquote", "p"), skipped_classes=("ad",), date_format="dd.MM.yyyy HH:mm")
    r = H.parse_pages(df, rules=rules).first()
    assert (r.text, r.date) == ("quoted\nplain", dt.datetime(2024, 5, 6, 7, 8))
    assert H.parse_pages(df, rules=SiteRules(article_classes=("mine",))).first().text == "plain\nad"


def test_nested_articles(spark):
    page = "<article class='type-post'><p>a</p><article class='type-post'><p>b</p></article></article>"
    assert H.parse_html(page).body_text().split("\n") == ["a", "b", "b"]


def test_parallel_edges_and_hubs(spark):
    nodes = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "node_id long, label string")
    edges = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, 3, "c")], "src long, dst long, label string")
    got = {r.node_id: r.adjacency for r in G.adjacency(nodes, edges).collect()}
    assert got == {1: {"2": {"label": "b"}, "3": {"label": "c"}}, 2: {}, 3: {}}
    assert sorted(map(tuple, G.adjacency_rows(edges).collect())) == [(1, 2, "b"), (1, 3, "c")]
    with pytest.raises(Exception, match="too many neighbours"):
        G.adjacency(nodes, edges, max_degree=1).collect()


def test_offset_without_a_colon(spark):
    df = spark.createDataFrame([("2024-05-06T07:08:09+0300",), ("2024-05-06T07:08:09+03:00",), ("2024-05-06T04:08:09Z",)], "t string")
    got = {r[0] for r in df.select(D.unify_date_instant(F.col("t")).cast("string")).collect()}
    assert got == {"2024-05-06 04:08:09"}


def _site(spark):
    def page(i, url, *hrefs, status=200):
        return i, url, "".join(f"<a href='{h}'>x</a>" for h in hrefs), status
    return spark.createDataFrame([
        page(1, "https://s/", "/page/1", "/n1#c", "https://o/x"), page(2, "https://s/page/1", "/n1", "/n2", "/page/2", "/"),
        page(3, "https://s/n1", "/n3", "/page/1"), page(4, "https://s/page/2", "/n4", status=500), page(5, "https://s/n2", "/n5"),
        page(6, "https://s/n3", "/n6")], "page_id long, url string, html string, status int")


def test_crawl_over_pages(spark):
    seeds = spark.createDataFrame([("https://s/", 0)], "url string, seed_order long")
    rows = C.crawl_pages(_site(spark), seeds).orderBy("place").collect()
    assert [(r.url, r.kind, r.depth) for r in rows] == [
        ("https://s/page/1", "navigation", 1), ("https://s/n1", "article", 1), ("https://s/n2", "article", 2),
        ("https://s/page/2", "navigation", 2), ("https://s/n3", "article", 2), ("https://s/n5", "article", 3), ("https://s/n6", "article", 3)]
    some = C.crawl_pages(_site(spark), seeds, enough=2).filter("kind = 'article'").orderBy("place").collect()
    assert [r.url for r in some] == ["https://s/n1", "https://s/n2"]
    only = C.crawl_pages(_site(spark), seeds, url_pattern="n[12]$").filter("kind = 'article'").collect()
    assert {r.url for r in only} == {"https://s/n1", "https://s/n2"}


def test_crawl_over_pages_resumes(spark):
    seeds = spark.createDataFrame([("https://s/", 0)], "url string, seed_order long")
    state = tempfile.mkdtemp(prefix="crawl-")
    first = C.crawl_pages(_site(spark), seeds, state_dir=state, max_rounds=1).count()
    assert first == 2
    whole = sorted(map(tuple, C.crawl_pages(_site(spark), seeds).collect()))
    # the pages are not read again: the state holds their links
    nothing = _site(spark).limit(0)
    assert sorted(map(tuple, C.crawl_pages(nothing, seeds, state_dir=state).collect())) == whole
