"""CoNLL-U render / parse queries over rule-annotated documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.conllu import parse_feats
from corpusflow.operators.annotate import document_sentences
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import token_sql
from corpusflow.plans.text_queries import doc_tokens, documents
from corpusflow.schemas import TOKEN_COLUMNS
from corpusflow.sinks.conllu import render_sentence_rows
from corpusflow.sources.conllu import parse_conllu


def _render_sql(feats: str) -> str:
    return token_sql() + f"""
, blocks AS (
  SELECT t.article_id, t.sent_id,
    '# sent_id = ' || CAST(t.sent_id + 1 AS VARCHAR) || chr(10) || '# text = ' || coalesce(s.sentence, '')
      || chr(10) || string_agg(t.line, chr(10) ORDER BY t.id) || chr(10) || chr(10) AS block
  FROM (SELECT article_id, sent_id, id,
          concat_ws(chr(9), id, form, lemma, upos, xpos, {feats}, head, deprel, deps, misc) AS line
        FROM tokens) t
  LEFT JOIN sents s ON s.article_id = t.article_id AND s.sent_id = t.sent_id
  GROUP BY t.article_id, t.sent_id, s.sentence
)
SELECT article_id, string_agg(block, '' ORDER BY sent_id) AS conllu FROM blocks GROUP BY article_id"""


@register("conllu_render", _render_sql("feats"))
def q_conllu_render(spark, sf):
    return render_sentence_rows(document_sentences(documents(spark, sf), with_text=True))


@register("conllu_render_no_feats", _render_sql("'_'"))
def q_conllu_render_no_feats(spark, sf):
    return render_sentence_rows(document_sentences(documents(spark, sf), with_text=True), include_feats=False)


@register("conllu_roundtrip", token_sql() + """
SELECT * FROM tokens""")
def q_conllu_roundtrip(spark, sf):
    return parse_conllu(render_sentence_rows(document_sentences(documents(spark, sf), with_text=True), merged=True)).select(*TOKEN_COLUMNS)


@register("parse_feats", token_sql() + """
SELECT article_id, sent_id, id, split_part(f, '=', 1) AS feat, split_part(f, '=', 2) AS value
FROM (SELECT article_id, sent_id, id, unnest(string_split(feats, '|')) AS f
      FROM tokens WHERE feats <> '_')""")
def q_parse_feats(spark, sf):
    toks = doc_tokens(spark, sf)
    return toks.select("article_id", "sent_id", "id",
                       F.explode(parse_feats(F.col("feats"))).alias("feat", "value"))
