"""Matches of small pattern graphs, cycles included, in graphs with hubs.

``operators.graph.match_pattern`` follows the pattern's edges as they are given,
which builds every path before a cycle closes.  Here the data edges that fit each
pattern edge (its label and the labels of both ends) are written and counted first.
Matching starts at the pattern edge with the fewest and takes in one variable at a
time; a variable with several matched neighbours is looked up, row by row, among the
edges of the neighbour that has the fewest, and checked against the others.  A hub
is so only expanded where all other neighbours are hubs as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import materialize

PatternEdge = tuple[str, str, str | None]


def _fitting(nodes: dict[str, DataFrame], edges: DataFrame, g: list[str], e: PatternEdge) -> DataFrame:
    """The data edges that fit a pattern edge, as ``(*g, a, b)``, each once."""
    a, b, label = e
    own = edges if label is None else edges.filter(F.col("label") == label)
    own = own.select(*g, F.col("src").alias(a), F.col("dst").alias(b)).filter(F.col(a) != F.col(b))
    return own.join(nodes[a], [*g, a], "left_semi").join(nodes[b], [*g, b], "left_semi").distinct()


def _take_in(partial: DataFrame, g: list[str], new: str, ways: list[tuple[str, DataFrame]]) -> DataFrame:
    """Partial matches with ``new`` bound through all of ``ways``: (matched neighbour, edges ``(*g, neighbour, new)``)."""
    if len(ways) == 1:
        (near, edges), = ways
        return partial.join(edges, [*g, near])
    degrees = [f"_degree_{i}" for i in range(len(ways))]
    for name, (near, edges) in zip(degrees, ways, strict=True):
        partial = partial.join(edges.groupBy(*g, near).agg(F.count(F.lit(1)).alias(name)), [*g, near])
    least = F.least(*degrees)
    chosen = reduce(lambda c, i: c.when(F.col(degrees[i]) == least, i), range(1, len(ways)), F.when(F.col(degrees[0]) == least, 0))
    partial = partial.withColumn("_chosen", chosen).drop(*degrees)
    out = []
    for i, (near, edges) in enumerate(ways):
        rows = partial.filter(F.col("_chosen") == i).drop("_chosen").join(edges, [*g, near])
        for j, (other, check) in enumerate(ways):
            if j != i:
                rows = rows.join(check, [*g, other, new], "left_semi")
        out.append(rows)
    return reduce(DataFrame.unionByName, out)


def match_graph(nodes: DataFrame, edges: DataFrame, node_labels: dict[str, str], pattern_edges: Sequence[PatternEdge],
                graph_cols: Sequence[str] = (), node_match: Callable[[str], Column] | None = None, induced: bool = False) -> DataFrame:
    """All matches of a connected pattern graph, each once: ``(*graph_cols, *variables)``.

    ``nodes(*graph_cols, node_id, label, ...)``, ``edges(*graph_cols, src, dst, label)``;
    ``node_labels``: label per variable; ``pattern_edges``: (variable, variable, label or None
    for any).  Different variables are different nodes; parallel data edges of one label count
    once.  ``node_match(var)`` is a further predicate on a node row; ``induced`` forbids data
    edges between matched nodes that the pattern lacks.
    """
    g, variables = list(graph_cols), list(node_labels)

    def rows_of(var: str) -> DataFrame:
        fits = F.col("label") == node_labels[var]
        return nodes.filter(fits if node_match is None else fits & node_match(var)).select(*g, F.col("node_id").alias(var)).distinct()

    own = {v: rows_of(v) for v in variables}
    if not pattern_edges:
        if len(variables) > 1:
            raise ValueError("pattern graph is not connected")
        return own[variables[0]]
    todo = {e: materialize(_fitting(own, edges, g, e), "pattern-edges") for e in dict.fromkeys(pattern_edges)}
    count = {e: rows.count() for e, rows in todo.items()}
    start = min(todo, key=lambda e: count[e])
    partial, bound = todo.pop(start), set(start[:2])
    while True:
        for e in [e for e in todo if set(e[:2]) <= bound]:  # parallel to edges that are matched
            partial = partial.join(todo.pop(e), [*g, *e[:2]], "left_semi")
        ways: dict[str, list[PatternEdge]] = {}
        for e in todo:
            for near, new in (e[:2], e[1::-1]):
                if near in bound and new not in bound:
                    ways.setdefault(new, []).append(e)
        if not ways:
            break
        new = min(ways, key=lambda v: (-len(ways[v]), min(count[e] for e in ways[v])))
        near = [(e[0] if e[1] == new else e[1], todo.pop(e)) for e in ways[new]]
        # two edges to one neighbour are one way
        both: dict[str, DataFrame] = {}
        for v, rows in near:
            both[v] = both[v].join(rows, [*g, v, new], "left_semi") if v in both else rows
        partial = _take_in(partial, g, new, list(both.items()))
        for v in bound:
            partial = partial.filter(F.col(v) != F.col(new))
        bound.add(new)
    if todo or bound != set(variables):
        raise ValueError("pattern graph is not connected")
    if induced:
        have = {e[:2] for e in pattern_edges}
        for a in variables:
            for b in variables:
                if a != b and (a, b) not in have:
                    partial = partial.join(edges.select(*g, F.col("src").alias(a), F.col("dst").alias(b)), [*g, a, b], "left_anti")
    return partial.select(*g, *variables)
