import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import patterns as P

PATTERNS = [
    ({"a": "x", "b": "y"}, [("a", "b", None)]),
    ({"a": "x", "b": "y", "c": "x"}, [("a", "b", None), ("b", "c", "r"), ("c", "a", None)]),
    ({"a": "x", "b": "x", "c": "y", "d": "y"}, [("a", "b", None), ("b", "c", None), ("c", "d", None), ("d", "a", None)]),
    ({"a": "x", "b": "x", "c": "x", "d": "y"}, [(p, q, None) for p, q in itertools.combinations("abcd", 2)]),
    ({"a": "x", "b": "y", "c": "y"}, [("a", "b", "r"), ("a", "b", "s"), ("c", "b", "r")]),
    ({"a": "x", "b": "y"}, [("a", "b", "r"), ("b", "a", "s")]),
    ({"a": "y"}, []),
]


def _graph(spark, seed, n=14, m=70):
    rnd = random.Random(seed)
    nodes = [(g, i, rnd.choice("xxy")) for g in (1, 2) for i in range(n)]
    edges = [(rnd.choice((1, 2)), rnd.randrange(n), rnd.randrange(n), rnd.choice("rs")) for _ in range(m)]
    edges += edges[:5]
    return nodes, edges, spark.createDataFrame(nodes, "g int, node_id long, label string"), spark.createDataFrame(edges, "g int, src long, dst long, label string")


def brute(nodes, edges, labels, pattern, induced=False):
    known = {(g, a, b, lab) for g, a, b, lab in edges} | {(g, a, b, None) for g, a, b, _ in edges}
    out = set()
    names = list(labels)
    for g in {n[0] for n in nodes}:
        for pick in itertools.product(*[[i for h, i, lab in nodes if h == g and lab == labels[v]] for v in names]):
            at = dict(zip(names, pick, strict=True))
            if len(set(pick)) < len(pick) or any((g, at[a], at[b], lab) not in known for a, b, lab in pattern):
                continue
            if induced and any((g, at[a], at[b], None) in known for a in names for b in names
                               if a != b and (a, b) not in {e[:2] for e in pattern}):
                continue
            out.add((g, *pick))
    return sorted(out)


@pytest.mark.parametrize("which", range(len(PATTERNS)))
def test_against_all_assignments(spark, which):
    labels, pattern = PATTERNS[which]
    nodes, edges, nf, ef = _graph(spark, which)
    got = P.match_graph(nf, ef, labels, pattern, ["g"])
    assert got.columns == ["g", *labels]
    assert sorted(map(tuple, got.collect())) == brute(nodes, edges, labels, pattern)


def test_induced_and_node_predicates(spark):
    labels, pattern = PATTERNS[1]
    nodes, edges, nf, ef = _graph(spark, 11)
    assert sorted(map(tuple, P.match_graph(nf, ef, labels, pattern, ["g"], induced=True).collect())) == brute(nodes, edges, labels, pattern, True)
    some = P.match_graph(nf, ef, labels, pattern, ["g"], node_match=lambda v: F.col("node_id") > (5 if v == "a" else -1)).collect()
    assert sorted(map(tuple, some)) == [r for r in brute(nodes, edges, labels, pattern) if r[1] > 5]


def test_unconnected_patterns_are_refused(spark):
    _, _, nf, ef = _graph(spark, 1)
    with pytest.raises(ValueError, match="not connected"):
        P.match_graph(nf, ef, {"a": "x", "b": "x", "c": "x", "d": "x"}, [("a", "b", None), ("c", "d", None)], ["g"])
    with pytest.raises(ValueError, match="not connected"):
        P.match_graph(nf, ef, {"a": "x", "b": "x"}, [], ["g"])


def test_a_hub_does_not_build_all_paths(spark):
    """20,000 leaves point to and from one hub; only one triangle closes."""
    n = 20_000
    nodes = spark.range(n + 1).select(F.col("id").alias("node_id"), F.when(F.col("id") == 0, "hub").otherwise("leaf").alias("label"))
    leaf = spark.range(1, n + 1)
    edges = leaf.select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), F.lit("r").alias("label")) \
        .unionByName(leaf.select(F.col("id").alias("src"), F.lit(0).cast("long").alias("dst"), F.lit("r").alias("label"))) \
        .unionByName(spark.range(n - 1).select((F.col("id") + 1).alias("src"), (F.col("id") + 2).alias("dst"), F.lit("near").alias("label")))
    # leaf -> hub -> leaf -> leaf: all paths through the hub are 400 million
    found = P.match_graph(nodes, edges, {"a": "leaf", "h": "hub", "b": "leaf"}, [("a", "h", "r"), ("h", "b", "r"), ("b", "a", "near")])
    assert found.count() == n - 1
