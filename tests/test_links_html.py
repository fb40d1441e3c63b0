from pyspark.sql import functions as F

from corpusflow.functions import urls as U
from corpusflow.operators import html as H
from corpusflow.operators import links as L

SEED = "https://host.ru/news/1"

# href -> expected full URL (fragment cut), values from FIXTURES.md
RESOLVE = [
    ("/a/b?x=1#y", "https://host.ru/a/b?x=1"),
    ("rel/p", "https://host.ru/rel/p"),
    ("#top", "https://host.ru/"),
    ("?q=1", "https://host.ru/?q=1"),
    ("../x", "https://host.ru/../x"),
    ("//cdn/x", "https://host.ru//cdn/x"),
    ("mailto:a@b", "https://host.ru/mailto:a@b"),
    ("HTTP://H/x", "https://host.ru/HTTP://H/x"),
]


def test_resolve_table(spark):
    df = spark.createDataFrame([(h, SEED) for h, _ in RESOLVE], "href string, url string")
    got = [r[0] for r in L.resolve_links(df).select("url_nofrag").collect()]
    assert got == [u for _, u in RESOLVE]


def test_navigation_and_same_site(spark):
    df = spark.createDataFrame([("https://host.ru/page/2/?a=/tag/",), ("https://host.ru/a/tagged",),
                                ("https://other.ru/x",)], "u string")
    r = df.select(U.is_navigation(F.col("u")).alias("nav"),
                  U.same_site(F.col("u"), F.lit(SEED)).alias("same")).collect()
    assert [(x.nav, x.same) for x in r] == [(True, True), (False, True), (False, False)]


def test_find_articles_first_seen_and_cap(spark):
    pages = spark.createDataFrame([
        (1, "https://s.ru/", '<a href="/a1">x</a><a href="/a2"></a><a href="/tag/x">t</a><a href="https://s.ru/">s</a>'),
        (2, "https://s.ru/x", '<a href="/a2">y</a><a href="/a3#c">z</a><a href="https://o.ru/a9">o</a>'),
    ], "page_id bigint, url string, html string")
    got = [(r.url, r.seed_order, r.pos) for r in L.find_articles(pages).orderBy("seed_order", "pos").collect()]
    assert got == [("https://s.ru/a1", 1, 0), ("https://s.ru/a2", 1, 1), ("https://s.ru/a3", 2, 1)]
    assert L.find_articles(pages, cap=2).count() == 2


def test_assign_ids_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    got = L.assign_ids(df, ["k"], num_partitions=5).orderBy("k").collect()
    assert [r.article_id for r in got] == list(range(1, 1001))


HTML_CASES = """<html><head><title> Big &amp; news </title>
<meta name="author" content="Анна"><meta name="author" content=""><meta content="Пётр" name="author">
<meta property="article:published_time" content="2024-05-01T10:20:30+03:00">
<meta name="keywords" content="спорт, город"><script>var s = "<p>no</p>";</script></head>
<body><article class="x type-post"><h1>Заголовок</h1>
<p>Glued <b>inline</b> text</p><p class="has-medium-font-size">skip me</p>
<ul><li>item <p>inner</p></li></ul><p><b>one<br><p>two</p></article>
<article class="other"><p>not this</p></article></body></html>"""


def test_parse_page_fields(spark):
    p = H.parse_html(HTML_CASES)
    assert p.title() == " Big & news "
    assert p.authors() == ["Анна", "Пётр"]
    assert p.published() == "2024-05-01T10:20:30+03:00"
    assert p.topics() == ["спорт", "город"]
    assert p.body_text().split("\n") == ["Заголовок", "Gluedinlinetext", "iteminner", "inner", "one", "two"]


def test_parse_pages_spark(spark):
    pages = spark.createDataFrame([(1, "https://s.ru/1", HTML_CASES), (2, "https://s.ru/2", "<p>no article</p>")],
                                  "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in H.parse_pages(pages).collect()}
    assert rows[1].author == ["Анна", "Пётр"]
    assert str(rows[1].date) == "2024-05-01 10:20:30"
    assert rows[2].text == "" and rows[2].author == ["NOT FOUND"] and rows[2].date is None
    assert rows[2].title == ""


def test_jvm_head_fields_agree(spark):
    from corpusflow.functions import html as HF
    pages = spark.createDataFrame([(1, HTML_CASES)], "page_id bigint, html string")
    r = pages.select(HF.page_title(F.col("html")).alias("t"), HF.page_authors(F.col("html")).alias("a"),
                     HF.page_topics(F.col("html")).alias("k"), HF.page_date_text(F.col("html")).alias("d")).first()
    p = H.parse_html(HTML_CASES)
    assert (r.t, r.a, r.k, r.d) == (p.title(), p.authors(), p.topics(), p.published())


def test_html_select(spark):
    pages = spark.createDataFrame([(1, '<div class="ad x">Buy <b>now</b></div><ul><li>a</li><li>b</li></ul>')],
                                  "page_id bigint, html string")
    sel = [H.Selector("ad", tag="div", cls="ad"), H.Selector("li", tag="li"),
           H.Selector("cls", tag="div", attr="class")]
    got = sorted((r.selector, r.pos, r.value) for r in H.html_select(pages, sel).collect())
    assert got == [("ad", 0, "Buynow"), ("cls", 0, "ad x"), ("li", 0, "a"), ("li", 1, "b")]


def test_site_rules(spark):
    from corpusflow.operators.site import SiteRules
    pages = spark.createDataFrame([
        (1, "https://s.ru/", '<a href="/news/2024/1">x</a><a href="/about">y</a><a href="/rubric/z">r</a>'),
    ], "page_id bigint, url string, html string")
    rules = SiteRules(nav_marks=("rubric",), url_pattern=r"/news/\d{4}/")
    got = [r.url for r in L.find_articles(pages, rules=rules).collect()]
    assert got == ["https://s.ru/news/2024/1"]
    html = '<article class="post"><p>a</p></article>'
    p2 = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    assert H.parse_pages(p2, rules=SiteRules(article_classes=("post",))).first().text == "a"
    assert H.parse_pages(p2, rules=SiteRules()).first().text == ""


def test_anchor_attributes_that_touch(spark):
    html = """<a class="x"href="/lost">a</a><a id='i'href='/b'title="t">b</a><a data-href="/no"href=/c>c</a><a/href="/d">d</a>
    <a title="a > b href='/no'" href="/e">e</a><abbr href="/no">f</abbr><a class="x"data-href="/no">g</a>"""
    pages = spark.createDataFrame([(1, "https://s.ru/", html)], "page_id bigint, url string, html string")
    assert [r.href for r in L.extract_links(pages).orderBy("pos").collect()] == ["/lost", "/b", "/c", "/d", "/e"]


def test_answers_below_400_are_fetched(spark):
    pages = spark.createDataFrame([(i, f"u{s}", "", s) for i, s in enumerate([200, 204, 304, 399, 400, 404, 500])],
                                  "page_id bigint, url string, html string, status int")
    assert [r.status for r in L.fetchable(pages).orderBy("page_id").collect()] == [200, 204, 304, 399]


def test_entity_columns_are_quick_to_build(spark):
    import time

    from corpusflow.functions import html as F_html
    pages = spark.createDataFrame([(1, "<meta name='keywords' content='a&amp;b'>")], "page_id bigint, html string")
    pages.select(F_html.page_topics(F.col("html")))
    began = time.perf_counter()
    df = pages.select(F_html.page_topics(F.col("html")).alias("topics"))
    assert time.perf_counter() - began < 0.5
    assert df.first().topics == ["a&b"]
