import random

from corpusflow.llm.components import connected_components


def test_components_of_chains_stars_and_random_links(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5), (None, 3), (7, None)]
    links += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)] * 2
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(links, "u long, v long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
