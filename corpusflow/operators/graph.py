"""Graph operators.

Graphs are two tables: ``nodes(<graph cols>, node_id, label, ...)`` and
``edges(<graph cols>, src, dst, label)``.  Pattern matching is a chain of
equi-joins on ``(graph, node)`` keys with the label predicates applied before
each join; matches never enumerate node pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.links import assign_ids
from corpusflow.session import materialize as written_once
from corpusflow.session import ship_package

SENTENCE = ["article_id", "sent_id"]


# --- dependency graphs from TOKEN tables ------------------------------------

def dependency_nodes(tokens: DataFrame) -> DataFrame:
    """G1 nodes: one per token, label = UPOS, text = form."""
    return tokens.select(*SENTENCE, F.col("id").alias("node_id"), F.col("upos").alias("label"),
                         F.col("form").alias("text"))


def dependency_graph(tokens: DataFrame) -> DataFrame:
    """G1 edges: head -> dependant labelled DEPREL; the root has no edge."""
    return tokens.filter(F.col("head") != 0).select(
        *SENTENCE, F.col("head").alias("src"), F.col("id").alias("dst"), F.col("deprel").alias("label"))


def dependency_edges(tokens: DataFrame) -> DataFrame:
    """Each dependant joined to its head in the same sentence."""
    dep = tokens.filter(F.col("head") != 0).select(
        *SENTENCE, F.col("head").alias("head_id"), F.col("id").alias("dep_id"),
        F.col("form").alias("dep_form"), F.col("upos").alias("dep_upos"), "deprel")
    head = tokens.select(*SENTENCE, F.col("id").alias("head_id"), F.col("form").alias("head_form"),
                         F.col("upos").alias("head_upos"))
    return dep.join(head, on=[*SENTENCE, "head_id"], how="inner")


def match_tree_path(tokens: DataFrame, labels: Sequence[str],
                    node_match: Callable[[DataFrame, int], Column] | None = None,
                    materialize: bool = False) -> DataFrame:
    """G3 on dependency trees: paths ``v1 -> v2 -> ... -> vk`` (head -> dependant)
    whose UPOS labels equal ``labels``.

    Every token has one head, so node and incoming edge are one row: step i is
    an equi-join of the tokens labelled ``labels[i]`` on
    ``(article_id, sent_id, head) = (.., .., v_{i-1})``.  The label filters are
    applied before any join.  On a stored TOKEN table every step is a scan with
    the label pushed down; when ``tokens`` is a computed plan, ``materialize``
    writes the label-filtered rows once (shared checkpoint folder) so the
    annotation is not recomputed for every step.
    Output ``(article_id, sent_id, id_1.., form_1.., upos_1..)``.
    """
    k = len(labels)
    base = tokens.filter(F.col("upos").isin(list(set(labels)))).select(
        *SENTENCE, "id", "head", "form", "upos")
    if materialize:
        base = written_once(base, "pattern-tokens")

    def step(i: int) -> DataFrame:
        t = base.filter(F.col("upos") == labels[i])
        if node_match is not None:
            t = t.filter(node_match(t, i))
        return t.select(*SENTENCE, F.col("id").alias(f"id_{i + 1}"), F.col("head").alias(f"head_{i + 1}"),
                        F.col("form").alias(f"form_{i + 1}"), F.col("upos").alias(f"upos_{i + 1}"))

    out = step(0)
    for i in range(1, k):
        nxt = step(i).withColumnRenamed(f"head_{i + 1}", f"id_{i}")
        out = out.join(nxt, on=[*SENTENCE, f"id_{i}"], how="inner")
    cols = [*SENTENCE] + [f"id_{i}" for i in range(1, k + 1)] + \
        [f"form_{i}" for i in range(1, k + 1)] + [f"upos_{i}" for i in range(1, k + 1)]
    return out.select(*cols)


def dependency_edges_in(sents: DataFrame) -> DataFrame:
    """J6 on sentence rows (``annotate_sentences``, ``group_sentences``): the head of a token is an
    element of its own sentence's array, so no join and no exchange is needed."""
    ts = F.col("tokens")
    pairs = F.transform(F.filter(ts, lambda t: t["head"] > 0), lambda t: F.struct(t.alias("d"), F.get(ts, t["head"] - 1).alias("h")))
    return sents.select(*SENTENCE, F.explode(pairs).alias("p")).filter(F.col("p.h").isNotNull()).select(
        *SENTENCE, F.col("p.d.head").alias("head_id"), F.col("p.d.id").alias("dep_id"), F.col("p.d.form").alias("dep_form"),
        F.col("p.d.upos").alias("dep_upos"), F.col("p.d.deprel").alias("deprel"), F.col("p.h.form").alias("head_form"),
        F.col("p.h.upos").alias("head_upos"))


def match_in_sentences(sents: DataFrame, labels: Sequence[str],
                       node_match: Callable[[Column, int], Column] | None = None) -> DataFrame:
    """G3 / J7 on sentence rows: the matches of ``match_tree_path``, found inside each row.

    A token has one head, so a path is fixed by its last token: those with the last label
    climb to their heads, one array lookup and one label test a step.  Work is linear in the
    sentence and nothing is shuffled.  ``node_match(token, i)`` (U7) is a further predicate on
    the token struct of step i.
    """
    k, ts = len(labels), F.col("tokens")

    def fits(t: Column, i: int) -> Column:
        own = t["upos"] == labels[i - 1]
        return own if node_match is None else own & node_match(t, i - 1)

    def step(paths: Column, i: int) -> Column:
        """The paths with their heads in front, as far as these fit label i."""
        behind = range(i + 1, k + 1)
        up = F.transform(paths, lambda p: F.struct(F.get(ts, p[f"v{i + 1}"]["head"] - 1).alias(f"v{i}"), *[p[f"v{j}"].alias(f"v{j}") for j in behind]))
        return F.filter(up, lambda p: fits(p[f"v{i}"], i))

    paths = F.transform(F.filter(ts, lambda t: fits(t, k)), lambda t: F.struct(t.alias(f"v{k}")))
    for i in range(k - 1, 0, -1):
        paths = step(paths, i)
    out = sents.select(*SENTENCE, F.explode(paths).alias("p"))
    return out.select(*SENTENCE, *[F.col(f"p.v{i}.{c}").alias(f"{n}_{i}") for n, c in (("id", "id"), ("form", "form"), ("upos", "upos"))
                                   for i in range(1, k + 1)])


def match_tree(k: int, i: int = 1) -> Column:
    """The nested tree ``{upos, text, children}`` of a path match, depth k."""
    children = (F.array().cast("array<string>") if i == k else F.array(match_tree(k, i + 1)))
    return F.struct(F.col(f"upos_{i}").alias("upos"), F.col(f"form_{i}").alias("text"),
                    children.alias("children"))


def match_trees(matches: DataFrame, k: int) -> DataFrame:
    """One tree per match -> ``(article_id, sent_id, id_1.., tree)``."""
    ids = [f"id_{i}" for i in range(1, k + 1)]
    return matches.select(*SENTENCE, *ids, match_tree(k).alias("tree"))


def pattern_matches_map(matches: DataFrame, k: int) -> DataFrame:
    """``{sentence index: [tree, ...]}`` per article, trees ordered by
    matched ids, only sentences with a match.  A per-sentence then per-article
    collect: its size is bounded by the matches of one document."""
    ids = [f"id_{i}" for i in range(1, k + 1)]
    trees = match_trees(matches, k)
    per_sent = trees.groupBy(*SENTENCE).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*ids, "tree"))), lambda x: x["tree"]).alias("trees"))
    per_art = per_sent.groupBy("article_id").agg(
        F.map_from_entries(F.transform(
            F.array_sort(F.collect_list(F.struct("sent_id", "trees"))),
            lambda x: F.struct(x["sent_id"].cast("string").alias("key"), x["trees"].alias("value"))
        )).alias("pattern_matches"))
    return per_art


def grouped_trees(matches: DataFrame, k: int) -> DataFrame:
    """Matches sharing a root merged: children with the same node are
    merged level by level, bottom-up (one ``groupBy`` per level).

    Output ``(article_id, sent_id, id_1, tree)``.
    """
    leaf = F.struct(F.col(f"upos_{k}").alias("upos"), F.col(f"form_{k}").alias("text"),
                    F.array().cast("array<string>").alias("children"))
    cur = matches.select(*SENTENCE, *[f"id_{i}" for i in range(1, k + 1)],
                         *[f"upos_{i}" for i in range(1, k)], *[f"form_{i}" for i in range(1, k)],
                         leaf.alias("node"))
    for level in range(k - 1, 0, -1):
        keys = [*SENTENCE] + [f"id_{i}" for i in range(1, level + 1)]
        attrs = [f"upos_{i}" for i in range(1, level + 1)] + [f"form_{i}" for i in range(1, level + 1)]
        g = cur.groupBy(*keys, *attrs).agg(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(f"id_{level + 1}").alias("i"), "node"))),
                        lambda x: x["node"]).alias("children"))
        node = F.struct(F.col(f"upos_{level}").alias("upos"), F.col(f"form_{level}").alias("text"),
                        F.col("children").alias("children"))
        cur = g.select(*keys, *[c for c in attrs if not c.endswith(f"_{level}")], node.alias("node"))
    return cur.select(*SENTENCE, "id_1", F.col("node").alias("tree"))


def _batch_tree_depth(ids, heads):
    """Depth of every sentence in an Arrow batch.

    ``ids`` / ``heads`` hold each sentence's token ids (ascending) and heads.
    Heads are turned into global positions with one ``searchsorted`` over
    (sentence, id) keys (a head that names no token of the sentence counts as
    the root); pointer jumping then runs over the whole batch at once with
    numpy fancy indexing, at most ceil(log2(longest sentence)) + 1 steps.
    """
    import numpy as np
    import pandas as pd
    lens = ids.map(len).to_numpy(dtype=np.int64)
    if len(lens) == 0 or lens.sum() == 0:
        return pd.Series([None] * len(lens), dtype="Int64")
    fid = np.concatenate([np.asarray(x, dtype=np.int64) for x in ids])
    fhead = np.concatenate([np.asarray(x, dtype=np.int64) for x in heads])
    sent = np.repeat(np.arange(len(lens), dtype=np.int64), lens)
    width = int(max(fid.max(), fhead.max(), 0)) + 1
    key = sent * width + fid
    hkey = sent * width + np.clip(fhead, 0, None)
    pos = np.minimum(np.searchsorted(key, hkey), len(key) - 1)
    anc = np.where((fhead > 0) & (key[pos] == hkey), pos, -1)
    dist = np.ones(len(fid), dtype=np.int64)
    for _ in range(int(lens.max()).bit_length() + 1):
        has = anc >= 0
        if not has.any():
            break
        idx = anc[has]
        new_dist = dist.copy()
        new_dist[has] = dist[has] + dist[idx]
        new_anc = anc.copy()
        new_anc[has] = anc[idx]
        dist, anc = new_dist, new_anc
    out = np.full(len(lens), -1, dtype=np.int64)
    done = anc < 0
    np.maximum.at(out, sent[done], dist[done])
    return pd.Series(out).where(out > 0).astype("Int64")


def tree_depth(tokens: DataFrame) -> DataFrame:
    """Depth (nodes on the longest root-to-leaf path) of every sentence.

    One shuffle groups each sentence's tokens sorted by id (the collect is
    bounded by one sentence); an Arrow-batched pandas UDF resolves heads to
    positions and runs pointer jumping over whole batches of sentences with
    numpy (higher-order SQL functions are interpreted per element, and map
    lookups scan linearly, so the vectorised form is used here).  Nodes on a
    head cycle never reach the root and do not count.
    """
    ship_package(tokens.sparkSession)
    per = tokens.groupBy(*SENTENCE).agg(F.array_sort(F.collect_list(F.struct("id", "head"))).alias("t"))
    depth = F.pandas_udf(_batch_tree_depth, "bigint")
    return per.select(*SENTENCE, depth(F.col("t.id"), F.col("t.head")).alias("depth"))


def tree_depth_in(sents: DataFrame) -> DataFrame:
    """A12 on sentence rows: ``(article_id, sent_id, depth)`` as ``tree_depth`` has it, without an exchange."""
    ship_package(sents.sparkSession)
    depth = F.pandas_udf(_batch_tree_depth, "bigint")
    return sents.select(*SENTENCE, depth(F.col("tokens.id"), F.col("tokens.head")).alias("depth"))


# --- attributed graphs (events) ---------------------------------------------

def sequence_edges(df: DataFrame, group: str, order: list[str], node: str,
                   steps: dict[str, int]) -> DataFrame:
    """Edges from each row to the row ``n`` places later in the same
    ``group`` (``steps = {"next": 1, "skip": 2}``).

    Instead of a window per group (a group holding a third of the rows would
    be one task), rows get global consecutive numbers in (group, order) by
    range partitioning (``assign_ids``); the edge is an equi-join on
    ``seq + n`` -- unique keys, evenly hashed -- kept when the group matches.
    """
    names = list(dict.fromkeys([group, *order, node]))
    seq = assign_ids(df.select(*names), names, id_col="_seq")  # written once, read by every step
    seq = seq.select(group, node, "_seq")
    out = None
    for label, n in steps.items():
        dst = seq.select(F.col(group).alias("_g2"), F.col(node).alias("dst"),
                         (F.col("_seq") - n).alias("_seq"))
        e = (seq.join(dst, on="_seq").filter(F.col(group) == F.col("_g2"))
             .select(group, F.col(node).alias("src"), "dst", F.lit(label).alias("label")))
        out = e if out is None else out.unionByName(e)
    return out


def match_pattern(nodes: DataFrame, edges: DataFrame, node_labels: dict[str, str],
                  pattern_edges: Sequence[tuple[str, str, str | None]], graph_cols: Sequence[str] = (),
                  node_match: Callable[[str], Column] | None = None,
                  induced: bool = False) -> DataFrame:
    """All matches of a small pattern graph (labelled nodes, optional
    edge labels) -> one row per match, one column per pattern variable.

    Joins follow the pattern edges from the first variable; each new variable
    is joined through an edge on its bound neighbour and then filtered by its
    node predicate: the label, and ``node_match(var)`` (U7) if given, a
    predicate over the node row's columns (e.g. other attributes).  Distinct
    variables map to distinct nodes.  ``induced`` also forbids data edges
    between matched nodes that the pattern lacks.
    """
    g = list(graph_cols)
    variables = list(node_labels)

    def node_rows(var: str) -> DataFrame:
        cond = F.col("label") == node_labels[var]
        if node_match is not None:
            cond = cond & node_match(var)
        return nodes.filter(cond).select(*g, F.col("node_id").alias(var))

    def edge_rows(a: str, b: str, lab: str | None) -> DataFrame:
        e = edges if lab is None else edges.filter(F.col("label") == lab)
        return e.select(*g, F.col("src").alias(a), F.col("dst").alias(b))

    first = pattern_edges[0][0] if pattern_edges else variables[0]
    out = node_rows(first)
    bound = {first}
    pending = list(pattern_edges)
    while pending:
        for idx, (a, b, lab) in enumerate(pending):
            if a in bound or b in bound:
                break
        else:
            raise ValueError("pattern graph is not connected")
        a, b, lab = pending.pop(idx)
        if a in bound and b in bound:
            out = out.join(edge_rows(a, b, lab), on=[*g, a, b], how="left_semi")
        elif a in bound:
            out = out.join(edge_rows(a, b, lab), on=[*g, a]).join(node_rows(b), on=[*g, b])
            bound.add(b)
        else:
            out = out.join(edge_rows(a, b, lab), on=[*g, b]).join(node_rows(a), on=[*g, a])
            bound.add(a)
    for i, x in enumerate(variables):
        for y in variables[i + 1:]:
            out = out.filter(F.col(x) != F.col(y))
    if induced:
        have = {(a, b) for a, b, _ in pattern_edges}
        for x in variables:
            for y in variables:
                if x != y and (x, y) not in have:
                    out = out.join(edge_rows(x, y, None), on=[*g, x, y], how="left_anti")
    return out.select(*g, *variables)


def adjacency_rows(edges: DataFrame, graph_cols: Sequence[str] = ()) -> DataFrame:
    """A11 as rows: ``(*graph_cols, node_id, dst, label)``, one per ordered pair of nodes.

    A directed graph holds one edge per pair: of parallel edges the greatest
    label stays.  The form for hubs: no node's neighbours are gathered.
    """
    g = list(graph_cols)
    return edges.groupBy(*g, F.col("src").alias("node_id"), "dst").agg(F.max("label").alias("label"))


def adjacency(nodes: DataFrame, edges: DataFrame, graph_cols: Sequence[str] = (),
              max_degree: int = 100_000) -> DataFrame:
    """Per node ``{neighbour: {label: ...}}``; nodes without out-edges map
    to ``{}``.  One row per node (never one map for the whole graph).

    A map is one row, so a node may have at most ``max_degree`` neighbours;
    more raise an error (use ``adjacency_rows``)."""
    g = list(graph_cols)
    e = adjacency_rows(edges, g)
    degree = e.groupBy(*g, "node_id").agg(F.count(F.lit(1)).alias("_degree"))
    checked = F.when(F.col("_degree") <= max_degree, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("too many neighbours for one map: node "), F.col("node_id").cast("string"))).cast("boolean"))
    e = e.join(degree.filter(checked).drop("_degree"), on=[*g, "node_id"])
    j = nodes.select(*g, "node_id").join(e, on=[*g, "node_id"], how="left")
    entry = F.when(F.col("dst").isNotNull(), F.struct(F.col("dst").alias("d"), F.col("label").alias("l")))
    agg = j.groupBy(*g, "node_id").agg(F.array_sort(F.collect_list(entry)).alias("es"))
    entries = F.transform("es", lambda x: F.struct(x["d"].cast("string").alias("key"),
                                                   F.create_map(F.lit("label"), x["l"]).alias("value")))
    return agg.select(*g, "node_id", F.map_from_entries(entries).alias("adjacency"))
