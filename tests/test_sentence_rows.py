"""Sentences as one row: annotation, matching and rendering inside the row."""

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import annotate as A
from corpusflow.operators import graph as G
from corpusflow.plans.text_queries import doc_tokens
from corpusflow.session import load_table
from corpusflow.sinks.conllu import render_conllu, render_sentence_rows
from corpusflow.sources.conllu import parse_conllu
from goldens import CONLLU_2

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_hold_the_tokens_of_the_table(spark):
    docs = load_table(spark, SF, "documents")
    table = doc_tokens(spark, SF)
    exploded = A.document_sentences(docs).select("article_id", "sent_id", F.explode("tokens").alias("t")).select("article_id", "sent_id", "t.*")
    assert exploded.columns == table.columns
    assert rows(exploded) == rows(table)


@pytest.mark.parametrize("labels", [("NOUN",), ("DET", "NOUN"), ("VERB", "NOUN", "ADP"), ("NOUN", "NOUN", "PUNCT", "NOUN"), ("X", "NOUN")])
def test_matches_equal_those_of_the_joins(spark, labels):
    docs = load_table(spark, SF, "documents")
    sents = A.document_sentences(docs, fields=("id", "form", "upos", "head"))
    found = G.match_in_sentences(sents, labels)
    assert "Exchange" not in plan(found) and "Join" not in plan(found)
    assert rows(found) == rows(G.match_tree_path(doc_tokens(spark, SF), labels).select(*found.columns))


def test_golden_document_through_the_token_table(spark):
    docs = spark.createDataFrame([(2, CONLLU_2)], "article_id long, conllu string")
    sents = A.group_sentences(parse_conllu(docs))
    found = G.match_in_sentences(sents, ("VERB", "NOUN", "ADP"))
    assert plan(found).count("Exchange hashpartitioning") <= 1
    assert rows(found) == rows(G.match_tree_path(parse_conllu(docs), ("VERB", "NOUN", "ADP"))) and found.count() == 4
    # trees branch here: a head has several matching dependants
    assert rows(G.match_in_sentences(sents, ("NOUN", "ADP"))) == rows(G.match_tree_path(parse_conllu(docs), ("NOUN", "ADP")))
    upper = G.match_in_sentences(sents, ("NOUN", "ADP"), node_match=lambda t, i: (F.lit(i) == 0) | (F.length(t["form"]) > 1))
    assert 0 < upper.count() < G.match_in_sentences(sents, ("NOUN", "ADP")).count()
    assert rows(G.dependency_edges_in(sents)) == rows(G.dependency_edges(parse_conllu(docs)))


def test_matches_that_share_a_root_are_merged(spark):
    # one verb with two nouns, one of which has two adpositions
    toks = [(1, 0, 1, "runs", "VERB", 0), (1, 0, 2, "a", "NOUN", 1), (1, 0, 3, "b", "NOUN", 1), (1, 0, 4, "in", "ADP", 2), (1, 0, 5, "on", "ADP", 2),
            (1, 0, 6, "at", "ADP", 3), (1, 1, 1, "x", "NOUN", 0)]
    table = spark.createDataFrame(toks, "article_id long, sent_id int, id int, form string, upos string, head int")
    found = G.match_in_sentences(A.group_sentences(table, ("id", "form", "upos", "head")), ("VERB", "NOUN", "ADP"))
    assert [(r.id_1, r.id_2, r.id_3) for r in found.orderBy("id_2", "id_3").collect()] == [(1, 2, 4), (1, 2, 5), (1, 3, 6)]
    (tree,) = [r.tree.asDict(True) for r in G.grouped_trees(found, 3).collect()]
    assert [(c["text"], [x["text"] for x in c["children"]]) for c in tree["children"]] == [("a", ["in", "on"]), ("b", ["at"])]


def test_ids_must_count_from_one(spark):
    table = spark.createDataFrame([(1, 0, 1, "a", "X", 0), (1, 0, 3, "b", "X", 1)], "article_id long, sent_id int, id int, form string, upos string, head int")
    with pytest.raises(Exception, match="TokenIds"):
        A.group_sentences(table, ("id", "form", "upos", "head")).collect()
    heads = spark.createDataFrame([(1, 0, 1, "a", "X", 9), (1, 0, 2, "b", "X", -1)], "article_id long, sent_id int, id int, form string, upos string, head int")
    assert G.match_in_sentences(A.group_sentences(heads, ("id", "form", "upos", "head")), ("X", "X")).collect() == []


def test_depths(spark):
    docs = load_table(spark, SF, "documents")
    own = G.tree_depth_in(A.document_sentences(docs, fields=("id", "head")))
    assert "Exchange" not in plan(own) and rows(own) == rows(G.tree_depth(doc_tokens(spark, SF)))
    golden = parse_conllu(spark.createDataFrame([(2, CONLLU_2)], "article_id long, conllu string"))
    assert rows(G.tree_depth_in(A.group_sentences(golden))) == rows(G.tree_depth(golden))


def test_rendering(spark):
    docs = load_table(spark, SF, "documents")
    for feats in (True, False):
        own = render_sentence_rows(A.document_sentences(docs, with_text=True), feats)
        assert plan(own).count("Exchange hashpartitioning") == 1
        assert rows(own) == rows(render_conllu(doc_tokens(spark, SF, with_text=True), include_feats=feats))


def test_sentences_are_annotated_once(spark):
    docs = load_table(spark, SF, "documents")
    for df in (A.document_sentences(docs), G.dependency_edges_in(A.document_sentences(docs)), G.match_in_sentences(A.document_sentences(docs), ("VERB", "NOUN"))):
        assert plan(df).count("regexp_extract_all(") == 1


def test_round_trip_moves_blocks_not_tokens(spark):
    from corpusflow.plans.conllu_queries import q_conllu_roundtrip
    own = q_conllu_roundtrip(spark, SF)
    assert plan(own).count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" not in plan(own)
    assert rows(own) == rows(doc_tokens(spark, SF))


def test_repeated_ids_are_merged_as_the_table_is(spark):
    said = ["One is here now. Two is there, too! Three more came in", "One of them is other. Two is there, too!", "Nothing in common here"]
    docs = spark.createDataFrame([(1, said[0], "en"), (1, said[1], "en"), (1, said[1], "en"), (2, said[0], "en"), (None, said[0], None), (None, said[2], "en")],
                                 "doc_id long, text string, lang string")
    for feats in (True, False):
        own = render_sentence_rows(A.document_sentences(docs, with_text=True), feats, merged=True)
        assert plan(own).count("Exchange hashpartitioning") == 1
        assert rows(own) == rows(render_conllu(A.annotate_documents(docs, with_text=True), include_feats=feats))


def test_odd_documents(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "Only one sentence here", None), (None, "No id for this sentence", "xx")],
                                 "doc_id long, text string, lang string")
    assert [(r.article_id, len(r.tokens)) for r in A.document_sentences(docs).orderBy("article_id").collect()] == [(None, 5), (4, 4)]
    assert A.document_sentences(docs.limit(0)).collect() == []
