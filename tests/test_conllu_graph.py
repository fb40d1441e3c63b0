from pyspark.sql import functions as F

from corpusflow.operators import graph as G
from corpusflow.operators import stats as S
from corpusflow.sinks.conllu import render_conllu
from corpusflow.sources.conllu import parse_conllu
from corpusflow.schemas import TOKEN_COLUMNS
from goldens import CONLLU_2, PATTERN_2, POS_2


def tokens(spark):
    doc = spark.createDataFrame([(2, CONLLU_2)], "article_id bigint, conllu string")
    return parse_conllu(doc)


def test_parse_counts(spark):
    t = tokens(spark)
    assert t.count() == 19
    got = {r.upos: r.n for r in S.pos_frequencies(t).collect()}
    assert got == POS_2


def test_render_roundtrip(spark):
    t = tokens(spark)
    sents = t.select("article_id", "sent_id", F.col("text").alias("sentence")).distinct()
    out = render_conllu(t.select(*TOKEN_COLUMNS), sents).first()
    assert out.conllu == CONLLU_2
    back = parse_conllu(spark.createDataFrame([(2, out.conllu)], "article_id bigint, conllu string"))
    assert sorted(map(tuple, back.select(*TOKEN_COLUMNS).collect())) == \
        sorted(map(tuple, t.select(*TOKEN_COLUMNS).collect()))


def test_render_without_text_uses_space_after(spark):
    t = tokens(spark).select(*TOKEN_COLUMNS)
    out = render_conllu(t).first().conllu
    assert "# text = Гости пили чай из кружек." in out


def test_pattern_matches_golden(spark):
    m = G.match_tree_path(tokens(spark), ["VERB", "NOUN", "ADP"])
    got = {}
    for r in m.orderBy("sent_id", "id_1", "id_2", "id_3").collect():
        got.setdefault(r.sent_id, []).append((r.form_1, r.form_2, r.form_3))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in PATTERN_2.items()}


def _depth(tree):
    return 1 + max((_depth(c) for c in tree.get("children", [])), default=0)


def test_pattern_map_and_grouped(spark):
    import json
    m = G.match_tree_path(tokens(spark), ["VERB", "NOUN", "ADP"])
    pm = json.loads(G.pattern_matches_map(m, 3).select(F.to_json("pattern_matches")).first()[0])
    assert set(pm) == {"0", "1"} and len(pm["0"]) == 3 and len(pm["1"]) == 1
    assert all(_depth(t) == 3 for ts in pm.values() for t in ts)
    grouped = [json.loads(r[0]) for r in G.grouped_trees(m, 3).select(F.to_json("tree")).collect()]
    roots = {t["text"]: t for t in grouped}
    assert len(roots["принёс"]["children"]) == 2
    # grouped and ungrouped forms hold the same paths
    paths = sorted((t["text"], c["text"], g["text"]) for t in grouped for c in t["children"] for g in c["children"])
    flat = sorted((t["text"], t["children"][0]["text"], t["children"][0]["children"][0]["text"])
                  for ts in pm.values() for t in ts)
    assert paths == flat


def test_tree_depth(spark):
    d = {r.sent_id: r.depth for r in G.tree_depth(tokens(spark)).collect()}
    # sentence 0: 4 -> 9 -> 12 -> 11; sentence 1: 2 -> 5 -> 4
    assert d == {0: 4, 1: 3}


def test_dependency_edges(spark):
    e = G.dependency_edges(tokens(spark))
    assert e.count() == 17
    r = e.filter((F.col("sent_id") == 0) & (F.col("dep_id") == 3)).first()
    assert (r.head_form, r.dep_form, r.deprel) == ("принёс", "другом", "obl")


def test_family_pattern_and_adjacency(spark):
    people = [("Оля", "blue"), ("Петя", "brown"), ("Юля", "brown"), ("Никита", "blue"), ("Костя", "blue")]
    nodes = spark.createDataFrame(people, "node_id string, label string")
    edges = spark.createDataFrame([("Оля", "Юля", "mother"), ("Петя", "Юля", "father"),
                                   ("Юля", "Костя", "mother"), ("Никита", "Костя", "father")],
                                  "src string, dst string, label string")
    m = G.match_pattern(nodes, edges, {"grandparent": "blue", "parent": "brown", "child": "blue"},
                        [("grandparent", "parent", None), ("parent", "child", None)])
    assert [tuple(r) for r in m.collect()] == [("Оля", "Юля", "Костя")]
    adj = {r.node_id: r.adjacency for r in G.adjacency(nodes, edges).collect()}
    assert adj == {"Оля": {"Юля": {"label": "mother"}}, "Петя": {"Юля": {"label": "father"}},
                   "Юля": {"Костя": {"label": "mother"}}, "Никита": {"Костя": {"label": "father"}},
                   "Костя": {}}


def test_sequence_edges_match_window(spark):
    from pyspark.sql import Window
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = G.sequence_edges(ev, "user_id", ["ts", "event_id"], "event_id", {"next": 1})
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    exp = ev.select("user_id", F.col("event_id").alias("src"), F.lead("event_id").over(w).alias("dst")) \
        .filter(F.col("dst").isNotNull())
    assert sorted(map(tuple, got.select("user_id", "src", "dst").collect())) == sorted(map(tuple, exp.collect()))


def test_tree_depth_cycles_and_bad_heads(spark):
    rows = [(1, 0, 1, 0), (1, 0, 2, 1), (1, 0, 3, 4), (1, 0, 4, 3),      # chain of 2 + a 2-cycle
            (1, 1, 1, 99), (1, 1, 2, 1), (1, 1, 3, 2),                   # head outside -> root
            (2, 0, 1, 2), (2, 0, 2, 1)]                                  # only a cycle
    t = spark.createDataFrame(rows, "article_id bigint, sent_id int, id int, head int")
    got = {(r.article_id, r.sent_id): r.depth for r in G.tree_depth(t).collect()}
    assert got == {(1, 0): 2, (1, 1): 3, (2, 0): None}


def test_pattern_node_match_and_induced(spark):
    people = [("Оля", "blue", 56), ("Петя", "brown", 60), ("Юля", "brown", 36), ("Никита", "blue", 35),
              ("Костя", "blue", 10)]
    nodes = spark.createDataFrame(people, "node_id string, label string, age int")
    edges = spark.createDataFrame([("Оля", "Юля", "mother"), ("Петя", "Юля", "father"),
                                   ("Юля", "Костя", "mother"), ("Никита", "Костя", "father")],
                                  "src string, dst string, label string")
    pat = {"grandparent": "blue", "parent": "brown", "child": "blue"}
    chain = [("grandparent", "parent", None), ("parent", "child", None)]

    def older_than(n):
        return lambda var: (F.col("age") > n) if var == "grandparent" else F.lit(True)

    assert G.match_pattern(nodes, edges, pat, chain, node_match=older_than(50)).count() == 1
    assert G.match_pattern(nodes, edges, pat, chain, node_match=older_than(60)).count() == 0
    assert G.match_pattern(nodes, edges, pat, chain, induced=True).count() == 1
    mothers = [("grandparent", "parent", "mother"), ("parent", "child", "mother")]
    assert G.match_pattern(nodes, edges, pat, mothers).count() == 1
    fathers = [("grandparent", "parent", "father"), ("parent", "child", None)]
    assert G.match_pattern(nodes, edges, pat, fathers).count() == 0
