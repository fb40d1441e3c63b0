"""Plan-shape checks: the scale properties the operators rely on."""

from corpusflow.operators import graph as G
from corpusflow.operators import links as L
from corpusflow.operators import stats as S
from corpusflow.plans.text_queries import doc_tokens
from corpusflow.session import load_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["url_pattern_filter"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p  # html is never read


def test_pos_counts_aggregate_partially(spark):
    p = plan(S.pos_frequencies(doc_tokens(spark, SF)))
    assert "partial_count" in p and "Window" not in p


def test_first_seen_uses_no_window(spark):
    p = plan(L.find_articles(load_table(spark, SF, "pages")))
    assert "Window" not in p and "partial_min" in p


def test_sequence_edges_not_windowed_by_group(spark):
    ev = load_table(spark, SF, "events")
    p = plan(G.sequence_edges(ev, "user_id", ["ts", "event_id"], "event_id", {"next": 1}))
    # the numbered rows were written once: no range exchange is left whose bounds
    # could differ from another's; the only window sums one count per partition,
    # never a window partitioned by the (possibly hot) group
    assert "rangepartitioning" not in p
    assert "windowspecdefinition(user_id" not in p


def test_ids_do_not_depend_on_exchange_reuse(spark):
    pages = load_table(spark, SF, "pages")
    p = plan(L.assign_ids(pages.select("page_id", "url", "html"), ["page_id"], key=["page_id"]))
    assert "rangepartitioning" not in p


def test_rule_annotator_has_no_python(spark):
    p = plan(doc_tokens(spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p
    assert "BroadcastHashJoin" in p  # the fixed lexicon


def test_token_table_roundtrip_and_pushdown(spark):
    import os
    import tempfile

    from corpusflow.sinks.tokens import read_tokens, write_tokens
    toks = doc_tokens(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="tokens-"), "t")
    write_tokens(toks, path, buckets=4)
    back = read_tokens(spark, path, upos=["VERB", "NOUN", "ADP"])
    assert "PushedFilters: [In(upos" in plan(back) or "In(upos," in plan(back)
    want = toks.filter("upos IN ('VERB', 'NOUN', 'ADP')")
    assert back.count() == want.count()
    m1 = sorted(map(tuple, G.match_tree_path(back, ["VERB", "NOUN", "ADP"]).collect()))
    m2 = sorted(map(tuple, G.match_tree_path(toks, ["VERB", "NOUN", "ADP"]).collect()))
    assert m1 == m2
