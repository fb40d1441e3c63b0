import os
import tempfile
from collections import deque


from corpusflow.operators import crawl as C


def bfs(edges, seeds):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, []).append(b)
    depth = {s: 0 for s in seeds}
    q = deque(seeds)
    while q:
        u = q.popleft()
        for v in adj.get(u, []):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    return depth


EDGES = [("s", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("s", "d"), ("d", "c"), ("c", "e"),
         ("e", "f"), ("f", "g"), ("g", "h"), ("h", "i"), ("i", "j"), ("j", "k"), ("k", "s"), ("x", "y")]


def test_crawl_matches_bfs(spark):
    links = spark.createDataFrame(EDGES, "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    for hops in (1, 3, 8):
        got = {r.url: r.depth for r in C.crawl_levels(links, seeds, hops_per_round=hops).collect()}
        assert got == bfs(EDGES, ["s"])


def test_crawl_resume_equals_uninterrupted(spark):
    links = spark.createDataFrame(EDGES, "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    state = os.path.join(tempfile.mkdtemp(prefix="crawl-"), "state")
    first = C.crawl_levels(links, seeds, state_dir=state, max_rounds=1, hops_per_round=2)
    assert first.count() < len(bfs(EDGES, ["s"]))
    resumed = {r.url: r.depth for r in C.crawl_levels(links, seeds, state_dir=state, hops_per_round=2).collect()}
    assert resumed == bfs(EDGES, ["s"])


def test_deep_chains_take_few_rounds(spark):
    # two chains of 300 with a way in at the middle, a tail that loops, and URLs that nothing reaches
    edges = [(f"c{i}", f"c{i + 1}") for i in range(300)] + [(f"d{i}", f"d{i + 1}") for i in range(300)]
    edges += [("c10", "d200"), ("c300", "c290"), ("d0", "d0"), ("x", "y"), ("y", "x")]
    links = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("c0",), ("d0",)], "url string")
    state = os.path.join(tempfile.mkdtemp(prefix="crawl-"), "state")
    got = {r.url: r.depth for r in C.crawl_levels(links, seeds, state_dir=state).collect()}
    assert got == bfs(edges, ["c0", "d0"])
    assert len(os.listdir(os.path.join(state, "visited"))) <= 9


def test_every_stop_has_whole_levels(spark):
    import random
    rnd = random.Random(5)
    for _ in range(2):
        edges = sorted({(f"u{rnd.randrange(40)}", f"u{rnd.randrange(40)}") for _ in range(50)} | {(f"u{i}", f"u{i + 1}") for i in range(0, 30, 2)})
        links, seeds = spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("u0",), ("u1",)], "url string")
        whole, state, found = bfs(edges, ["u0", "u1"]), os.path.join(tempfile.mkdtemp(prefix="crawl-"), "state"), {}
        while found != whole:
            before = len(found)
            found = {r.url: r.depth for r in C.crawl_levels(links, seeds, state_dir=state, max_rounds=1, hops_per_round=2).collect()}
            assert found == {u: k for u, k in whole.items() if k <= max(found.values())} and len(found) > before


def test_links_to_null_are_found_as_before(spark):
    links = spark.createDataFrame([("a", "b"), ("b", None), (None, "c")], "src string, dst string")
    got = C.crawl_levels(links, spark.createDataFrame([("a",)], "url string")).collect()
    assert sorted(map(tuple, got), key=str) == [("a", 0), ("b", 1), (None, 2)]


def test_crawl_enough_stops_early(spark):
    links = spark.createDataFrame(EDGES, "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    got = C.crawl_levels(links, seeds, enough=3, hops_per_round=1)
    assert 3 <= got.count() < len(bfs(EDGES, ["s"]))


def test_stream_new_urls_once(spark):
    from corpusflow.streaming.new_urls import run_new_urls
    src = tempfile.mkdtemp(prefix="pages-")
    pages = spark.createDataFrame([(1, "https://s.ru/", '<a href="/a">a</a><a href="/b">b</a>')],
                                  "page_id bigint, url string, html string")
    pages.write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    ck = os.path.join(tempfile.mkdtemp(prefix="ck-"), "c")
    tgt = os.path.join(tempfile.mkdtemp(prefix="tgt-"), "t")
    run_new_urls(spark, os.path.join(src, "batch1"), target=tgt, checkpoint=ck)
    # a second run with the same checkpoint processes no file twice
    run_new_urls(spark, os.path.join(src, "batch1"), target=tgt, checkpoint=ck)
    got = sorted(r.url for r in spark.read.parquet(tgt).collect())
    assert got == ["https://s.ru/a", "https://s.ru/b"]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["article_id", "upos", "n"] and df.count() > 0
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_bfs_levels_random_graphs(spark):
    import random
    rnd = random.Random(7)
    for trial in range(6):
        n = rnd.randint(5, 40)
        edges = set()
        # chains, cycles, fan-in and fan-out
        for _ in range(rnd.randint(n, 3 * n)):
            a, b = rnd.randrange(n), rnd.randrange(n)
            edges.add((f"u{a}", f"u{b}"))
        for i in range(0, n - 1, 3):
            edges.add((f"u{i}", f"u{i + 1}"))
        edges = sorted(edges)
        seeds = [f"u{i}" for i in rnd.sample(range(n), rnd.randint(1, 3))]
        links = spark.createDataFrame(edges, "src string, dst string")
        sd = spark.createDataFrame([(x,) for x in seeds], "url string")
        got = {r.url: r.depth for r in C.bfs_levels(links, sd).collect()}
        assert got == bfs(edges, seeds), trial


def test_bfs_levels_chain_and_cycle(spark):
    edges = [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("x", "y"), ("y", "z"), ("z", "x"), ("z", "w")]
    links = spark.createDataFrame(edges, "src string, dst string")
    sd = spark.createDataFrame([("c0",)], "url string")
    got = {r.url: r.depth for r in C.bfs_levels(links, sd).collect()}
    assert got == bfs(edges, ["c0"])


def test_stream_within_watermark(spark):
    from corpusflow.streaming.new_urls import run_new_urls
    src = tempfile.mkdtemp(prefix="pagesw-")
    pages = spark.createDataFrame([(1, "https://s.ru/", '<a href="/a">a</a><a href="/a">again</a>')],
                                  "page_id bigint, url string, html string")
    pages.write.mode("overwrite").parquet(os.path.join(src, "b"))
    tgt = run_new_urls(spark, os.path.join(src, "b"), within_watermark="1 hour")
    assert sorted(r.url for r in spark.read.parquet(tgt).collect()) == ["https://s.ru/a"]


def test_process_corpus_persists(spark):
    from corpusflow.operators.annotate import process_corpus
    arts = spark.createDataFrame([(1, "The cat is on the mat. A dog was here too!", "en")],
                                 "article_id bigint, text string, lang string")
    out = os.path.join(tempfile.mkdtemp(prefix="proc-"), "o")
    cleaned, toks = process_corpus(arts, "rules", out=out)
    mem_c, mem_t = process_corpus(arts, "rules")
    assert cleaned.first().cleaned == mem_c.first().cleaned
    assert sorted(map(tuple, toks.collect())) == sorted(map(tuple, mem_t.collect()))


def test_stream_incremental_arrivals(spark):
    from corpusflow.streaming.new_urls import run_new_urls
    src = tempfile.mkdtemp(prefix="pagesi-")
    schema = "page_id bigint, url string, html string"
    spark.createDataFrame([(1, "https://s.ru/", '<a href="/a">a</a><a href="/b">b</a>')], schema) \
        .write.parquet(os.path.join(src, "f1"))
    ck = os.path.join(tempfile.mkdtemp(prefix="cki-"), "c")
    tgt = os.path.join(tempfile.mkdtemp(prefix="tgti-"), "t")
    run_new_urls(spark, src, target=tgt, checkpoint=ck, glob="*.parquet")
    # a new file arrives: one URL already known, one new
    spark.createDataFrame([(2, "https://s.ru/x", '<a href="/b">b</a><a href="/c">c</a>')], schema) \
        .write.parquet(os.path.join(src, "f2"))
    run_new_urls(spark, src, target=tgt, checkpoint=ck, glob="*.parquet")
    got = [r.url for r in spark.read.parquet(tgt).collect()]
    assert sorted(got) == ["https://s.ru/a", "https://s.ru/b", "https://s.ru/c"]
