"""Graph queries: dependency graphs of rule-annotated documents and the
next-event graph of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import graph as G
from corpusflow.operators.annotate import document_sentences
from corpusflow.operators.patterns import match_graph
from corpusflow.operators.stats import pos_frequency_map
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import token_sql
from corpusflow.plans.text_queries import doc_tokens, documents
from corpusflow.session import load_table, scratch_path
from corpusflow.sinks.files import read_meta, update_meta, write_meta

PATTERN = ("VERB", "NOUN", "ADP")
EVENT_PATH = ("view", "click", "purchase")
EVENT_PATH_2 = ("click", "purchase")


def _path_sql(labels) -> str:
    k = len(labels)
    ins = ", ".join(f"'{x}'" for x in sorted(set(labels)))
    sel = ", ".join([f"t1.article_id, t1.sent_id"] + [f"t{i}.id AS id_{i}" for i in range(1, k + 1)]
                    + [f"t{i}.form AS form_{i}" for i in range(1, k + 1)]
                    + [f"t{i}.upos AS upos_{i}" for i in range(1, k + 1)])
    joins = "".join(
        f"\nJOIN b t{i} ON t{i}.article_id = t1.article_id AND t{i}.sent_id = t1.sent_id "
        f"AND t{i}.head = t{i - 1}.id AND t{i}.upos = '{labels[i - 1]}'" for i in range(2, k + 1))
    return (f"\n, b AS MATERIALIZED (SELECT article_id, sent_id, id, head, form, upos FROM tokens WHERE upos IN ({ins}))"
            f"\n, m AS MATERIALIZED (SELECT {sel} FROM b t1{joins} WHERE t1.upos = '{labels[0]}')")


def _tree_sql(k: int, i: int = 1) -> str:
    children = "[]::VARCHAR[]" if i == k else f"[{_tree_sql(k, i + 1)}]"
    return f"{{'upos': upos_{i}, 'text': form_{i}, 'children': {children}}}"


def matches(spark, sf):
    return G.match_in_sentences(document_sentences(documents(spark, sf), fields=("id", "form", "upos", "head")), PATTERN)


@register("dependency_graph", token_sql() + """
SELECT article_id, sent_id, head AS src, id AS dst, deprel AS label FROM tokens WHERE head <> 0""")
def q_dependency_graph(spark, sf):
    return G.dependency_graph(doc_tokens(spark, sf))


# a sentence's tokens are numbered from 1, so the head is an element of the sentence's list
@register("dependency_edges", token_sql() + """
, s AS MATERIALIZED (
  SELECT article_id, sent_id, list(form ORDER BY id) AS forms, list(upos ORDER BY id) AS tags, list(deprel ORDER BY id) AS rels,
         list(head ORDER BY id) AS heads FROM tokens GROUP BY article_id, sent_id),
e AS (SELECT *, unnest(range(1, len(heads) + 1))::INTEGER AS i FROM s)
SELECT article_id, sent_id, heads[i] AS head_id, i AS dep_id, forms[i] AS dep_form, tags[i] AS dep_upos, rels[i] AS deprel,
       forms[heads[i]] AS head_form, tags[heads[i]] AS head_upos
FROM e WHERE heads[i] <> 0""")
def q_dependency_edges(spark, sf):
    return G.dependency_edges_in(document_sentences(documents(spark, sf), fields=("id", "form", "upos", "head", "deprel")))


@register("pattern_match", token_sql() + _path_sql(PATTERN) + "\nSELECT * FROM m")
def q_pattern_match(spark, sf):
    return matches(spark, sf)


@register("match_trees", token_sql() + _path_sql(PATTERN) + f"""
SELECT article_id, sent_id, id_1, id_2, id_3, CAST(to_json({_tree_sql(3)}) AS VARCHAR) AS tree FROM m""")
def q_match_trees(spark, sf):
    t = G.match_trees(matches(spark, sf), 3)
    return t.select(*G.SENTENCE, "id_1", "id_2", "id_3", F.to_json("tree").alias("tree"))


_MAP_SQL = f"""
, per_sent AS (
  SELECT article_id, sent_id, to_json(list({_tree_sql(3)} ORDER BY id_1, id_2, id_3)) AS trees
  FROM m GROUP BY article_id, sent_id
), per_art AS (
  SELECT article_id, '{{' || string_agg('"' || CAST(sent_id AS VARCHAR) || '":' || trees, ',' ORDER BY sent_id) || '}}' AS pattern_matches
  FROM per_sent GROUP BY article_id
)"""


@register("pattern_matches_map", token_sql() + _path_sql(PATTERN) + _MAP_SQL + """
SELECT article_id, pattern_matches FROM per_art""")
def q_pattern_matches_map(spark, sf):
    m = G.pattern_matches_map(matches(spark, sf), 3)
    return m.select("article_id", F.to_json("pattern_matches").alias("pattern_matches"))


@register("pattern_search", token_sql() + _path_sql(PATTERN) + _MAP_SQL + """
SELECT d.doc_id + 1 AS article_id, coalesce(p.pattern_matches, '{}') AS pattern_matches
FROM documents d LEFT JOIN per_art p ON p.article_id = d.doc_id + 1""")
def q_pattern_search(spark, sf):
    m = G.pattern_matches_map(matches(spark, sf), 3)
    arts = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"))
    j = arts.join(m, on="article_id", how="left")
    return j.select("article_id", F.coalesce(F.to_json("pattern_matches"), F.lit("{}")).alias("pattern_matches"))


_GROUPED_SQL = """
, l2 AS (
  SELECT article_id, sent_id, id_1, id_2, upos_1, form_1, upos_2, form_2,
         list({'upos': upos_3, 'text': form_3, 'children': []::VARCHAR[]} ORDER BY id_3) AS ch
  FROM m GROUP BY ALL
), l1 AS (
  SELECT article_id, sent_id, id_1,
    {'upos': upos_1, 'text': form_1,
     'children': list({'upos': upos_2, 'text': form_2, 'children': ch} ORDER BY id_2)} AS tree
  FROM l2 GROUP BY article_id, sent_id, id_1, upos_1, form_1
)
SELECT article_id, sent_id, id_1, CAST(to_json(tree) AS VARCHAR) AS tree FROM l1"""


@register("pattern_matches_grouped", token_sql() + _path_sql(PATTERN) + _GROUPED_SQL)
def q_pattern_matches_grouped(spark, sf):
    g = G.grouped_trees(matches(spark, sf), 3)
    return g.select(*G.SENTENCE, "id_1", F.to_json("tree").alias("tree"))


# the rule annotator's trees are chains; with half its id as head, a token has two dependants
@register("pattern_matches_branching", token_sql() + _path_sql(PATTERN).replace("id, head, form", "id, id // 2 AS head, form") + _GROUPED_SQL)
def q_pattern_matches_branching(spark, sf):
    sents = document_sentences(documents(spark, sf), fields=("id", "form", "upos"))
    halved = F.transform("tokens", lambda t: F.struct(t["id"], t["form"], t["upos"], F.floor(t["id"] / 2).cast("int").alias("head")))
    g = G.grouped_trees(G.match_in_sentences(sents.withColumn("tokens", halved), PATTERN), 3)
    return g.select(*G.SENTENCE, "id_1", F.to_json("tree").alias("tree"))


@register("sentence_tree_depth", token_sql().replace("WITH ", "WITH RECURSIVE ", 1) + """
, walk(article_id, sent_id, id, depth) AS (
  SELECT article_id, sent_id, id, 1 FROM tokens WHERE head = 0
  UNION ALL
  SELECT t.article_id, t.sent_id, t.id, w.depth + 1
  FROM walk w JOIN tokens t ON t.article_id = w.article_id AND t.sent_id = w.sent_id AND t.head = w.id
)
SELECT article_id, sent_id, CAST(max(depth) AS BIGINT) AS depth FROM walk GROUP BY article_id, sent_id""")
def q_sentence_tree_depth(spark, sf):
    return G.tree_depth_in(document_sentences(documents(spark, sf), fields=("id", "head")))


# --- events graph -------------------------------------------------------------

_EVENTS_SQL = """
WITH s AS (
  SELECT user_id, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
), edges AS (
  SELECT a.user_id, a.event_id AS src, b.event_id AS dst, 'next' AS label
  FROM s a JOIN s b ON b.user_id = a.user_id AND b.rn = a.rn + 1
  UNION ALL
  SELECT a.user_id, a.event_id AS src, b.event_id AS dst, 'skip' AS label
  FROM s a JOIN s b ON b.user_id = a.user_id AND b.rn = a.rn + 2
)"""


def event_graph(spark, sf):
    e = load_table(spark, sf, "events")
    nodes = e.select("user_id", F.col("event_id").alias("node_id"), F.col("event_type").alias("label"))
    edges = G.sequence_edges(e, "user_id", ["ts", "event_id"], "event_id", {"next": 1, "skip": 2})
    return nodes, edges


@register("event_edges", _EVENTS_SQL + """
SELECT user_id, src, dst, label FROM edges WHERE label = 'next'""")
def q_event_edges(spark, sf):
    e = load_table(spark, sf, "events")
    return G.sequence_edges(e, "user_id", ["ts", "event_id"], "event_id", {"next": 1})


@register("adjacency_map", _EVENTS_SQL + """
SELECT s.user_id, s.event_id AS node_id,
  '{' || coalesce(string_agg('"' || CAST(e.dst AS VARCHAR) || '":{"label":"' || e.label || '"}', ',' ORDER BY e.dst), '') || '}' AS adjacency
FROM s LEFT JOIN edges e ON e.src = s.event_id AND e.user_id = s.user_id
GROUP BY s.user_id, s.event_id""")
def q_adjacency_map(spark, sf):
    nodes, edges = event_graph(spark, sf)
    a = G.adjacency(nodes, edges, ["user_id"])
    return a.select("user_id", "node_id", F.to_json("adjacency").alias("adjacency"))


def _event_path_sql(labels) -> str:
    k = len(labels)
    names = "abcdefgh"
    sel = ", ".join(["n1.user_id"] + [f"n{i}.event_id AS {names[i - 1]}" for i in range(1, k + 1)])
    joins = "".join(
        f"\nJOIN edges e{i} ON e{i}.user_id = n1.user_id AND e{i}.src = n{i - 1}.event_id AND e{i}.label = 'next'"
        f"\nJOIN s n{i} ON n{i}.user_id = n1.user_id AND n{i}.event_id = e{i}.dst AND n{i}.event_type = '{labels[i - 1]}'"
        for i in range(2, k + 1))
    return _EVENTS_SQL + f"\nSELECT {sel} FROM s n1{joins}\nWHERE n1.event_type = '{labels[0]}'"


def _event_path(spark, sf, labels):
    nodes, edges = event_graph(spark, sf)
    names = "abcdefgh"
    node_labels = {names[i]: lab for i, lab in enumerate(labels)}
    pat = [(names[i], names[i + 1], "next") for i in range(len(labels) - 1)]
    return G.match_pattern(nodes, edges, node_labels, pat, graph_cols=["user_id"])


@register("event_path_match", _event_path_sql(EVENT_PATH))
def q_event_path_match(spark, sf):
    return _event_path(spark, sf, EVENT_PATH)


@register("event_path_match_2", _event_path_sql(EVENT_PATH_2))
def q_event_path_match_2(spark, sf):
    return _event_path(spark, sf, EVENT_PATH_2)


@register("event_fanin_match", _EVENTS_SQL + """
SELECT c.user_id, a.event_id AS a, b.event_id AS b, c.event_id AS c
FROM s c
JOIN edges ea ON ea.user_id = c.user_id AND ea.dst = c.event_id AND ea.label = 'next'
JOIN s a ON a.user_id = c.user_id AND a.event_id = ea.src AND a.event_type = 'click'
JOIN edges eb ON eb.user_id = c.user_id AND eb.dst = c.event_id AND eb.label = 'skip'
JOIN s b ON b.user_id = c.user_id AND b.event_id = eb.src AND b.event_type = 'view'
WHERE c.event_type = 'purchase'""")
def q_event_fanin_match(spark, sf):
    nodes, edges = event_graph(spark, sf)
    return G.match_pattern(nodes, edges, {"a": "click", "b": "view", "c": "purchase"},
                           [("a", "c", "next"), ("b", "c", "skip")], graph_cols=["user_id"])


# users as nodes: an edge from each event's user to that of the next event, labelled by the event's type
_USER_SQL = """
WITH t AS (SELECT user_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events),
e AS MATERIALIZED (SELECT DISTINCT a.user_id AS src, b.user_id AS dst, a.event_type AS label FROM t a JOIN t b ON b.rn = a.rn + 1
                   WHERE a.user_id <> b.user_id)"""


def user_graph(spark, sf):
    e = load_table(spark, sf, "events").withColumn("everyone", F.lit(1))
    steps = G.sequence_edges(e, "everyone", ["ts", "event_id"], "event_id", {"next": 1})
    who = e.select(F.col("event_id").alias("src"), F.col("user_id").alias("a"), F.col("event_type").alias("label"))
    to = e.select(F.col("event_id").alias("dst"), F.col("user_id").alias("b"))
    edges = steps.select("src", "dst").join(who, "src").join(to, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"), "label")
    label = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    return e.select(F.col("user_id").alias("node_id"), label.alias("label")), edges


@register("user_triangle_match", _USER_SQL + """
SELECT x.src AS a, x.dst AS b, y.dst AS c FROM e x JOIN e y ON y.src = x.dst AND y.label = 'view' JOIN e z ON z.src = y.dst AND z.dst = x.src
WHERE x.label = 'view' AND z.label = 'click' AND x.src % 2 = 0 AND x.dst % 2 = 1 AND y.dst % 2 = 0""")
def q_user_triangle_match(spark, sf):
    nodes, edges = user_graph(spark, sf)
    return match_graph(nodes, edges, {"a": "even", "b": "odd", "c": "even"}, [("a", "b", "view"), ("b", "c", "view"), ("c", "a", "click")])


_FREQ_SQL = """
, freq AS (
  SELECT article_id, '{' || string_agg('"' || upos || '":' || n, ',' ORDER BY upos) || '}' AS pos
  FROM (SELECT article_id, upos, count(*) AS n FROM tokens GROUP BY article_id, upos) GROUP BY article_id
)"""


@register("meta_write_back", token_sql() + _path_sql(PATTERN) + _MAP_SQL + _FREQ_SQL + """
SELECT d.doc_id + 1 AS id, d.source AS title, coalesce(f.pos, '{}') AS pos_frequencies,
       coalesce(p.pattern_matches, CASE WHEN d.doc_id % 2 = 0 THEN '{"9":["kept"]}' END) AS pattern_matches
FROM documents d LEFT JOIN freq f ON f.article_id = d.doc_id + 1 LEFT JOIN per_art p ON p.article_id = d.doc_id + 1""")
def q_meta_write_back(spark, sf):
    # META with earlier matches on every second article is written; POS counts are put in, written and read
    # again (the earlier matches stay); then the new matches replace the earlier ones where there are any.
    articles = documents(spark, sf).select(
        (F.col("doc_id") + 1).alias("article_id"), F.col("source").alias("title"),
        F.when(F.col("doc_id") % 2 == 0, '{"9":["kept"]}').alias("pattern_matches"))
    first, second = scratch_path(spark, "meta"), scratch_path(spark, "meta")
    write_meta(articles, first)
    counts = pos_frequency_map(doc_tokens(spark, sf)).select("article_id", "pos_frequencies")
    write_meta(update_meta(read_meta(spark, first), counts=counts), second)
    found = G.pattern_matches_map(matches(spark, sf), 3)
    meta = update_meta(read_meta(spark, second), matches=found)
    ordered = F.map_from_entries(F.array_sort(F.map_entries("pos_frequencies")))
    return meta.select("id", "title", F.to_json(ordered).alias("pos_frequencies"), "pattern_matches")
