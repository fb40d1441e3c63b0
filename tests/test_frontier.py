import os
import random
import tempfile
from collections import Counter

from corpusflow.operators import frontier as Q


def _graph(seed, n=60):
    rnd = random.Random(seed)
    urls = [f"https://{'hot' if i % 3 else f'h{i % 5}'}/p{i}" for i in range(n)]
    return urls, sorted({(rnd.choice(urls), rnd.choice(urls)) for _ in range(2 * n)})


def _reached(links, seeds):
    seen, todo = set(seeds), list(seeds)
    while todo:
        at = todo.pop()
        for a, b in links:
            if a == at and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def test_quota_order_and_coverage(spark):
    urls, links = _graph(1)
    got = Q.crawl_frontier(spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame([(u,) for u in urls[:3]], "url string"), per_host=2).collect()
    assert {r.url for r in got} == _reached(links, urls[:3])
    assert all(r.fetched is not None and r.fetched > r.found for r in got)
    each = Counter((r.host, r.fetched) for r in got)
    assert max(each.values()) == 2
    # none waits while a later one of its host is fetched, and no turn of a waiting host is left out
    for a in got:
        assert not any(b.host == a.host and b.found > a.found and b.fetched < a.fetched for b in got)
        for turn in range(a.found + 1, a.fetched):
            assert each[a.host, turn] == 2
    # a URL is found in the round that fetches its first source
    fetched = {r.url: r.fetched for r in got}
    for r in got:
        if r.url not in urls[:3]:
            assert r.found == min(fetched[a] for a, b in links if b == r.url and a in fetched)


def test_stop_and_resume(spark):
    urls, links = _graph(2)
    lf, sd = spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame([(urls[0],), (urls[1],), (None,)], "url string")
    whole = sorted(map(tuple, Q.crawl_frontier(lf, sd, 3).collect()), key=str)
    state = os.path.join(tempfile.mkdtemp(prefix="frontier-"), "s")
    part = Q.crawl_frontier(lf, sd, 3, state_dir=state, max_rounds=2).collect()
    assert any(r.fetched is None for r in part)
    assert sorted(map(tuple, Q.crawl_frontier(lf, sd, 3, state_dir=state).collect()), key=str) == whole
    some = Q.crawl_frontier(lf, sd, 3, enough=5).count()
    assert 5 <= some < len(whole)
    assert Q.crawl_frontier(lf, sd.limit(0)).collect() == []


def test_a_hot_host_is_ranked_in_salts(spark):
    queue = spark.range(5_000).selectExpr("concat('https://hot/', id) AS url", "'hot' AS host", "cast(id % 7 AS int) AS found")
    batch = Q.next_batch(queue, 40).collect()
    assert len(batch) == 40 and {r.found for r in batch} == {0}
    assert sorted(r.url for r in batch) == sorted(r.url for r in Q.next_batch(queue, 40, salts=1).collect())


def test_a_round_is_few_jobs(spark):
    # a chain: one URL a round.  The tracker keeps the jobs of a group.
    links = spark.createDataFrame([(f"https://h/{i}", f"https://h/{i + 1}") for i in range(6)], "src string, dst string")
    seeds = spark.createDataFrame([("https://h/0",)], "url string")

    def jobs(rounds):
        group = f"frontier-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        got = Q.crawl_frontier(links, seeds, 2, max_rounds=rounds)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got.count() == rounds + 1
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert (jobs(5) - jobs(2)) / 3 <= 8
