"""Queries of the annotation slot (U1) and the corpus processing stage (U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import annotate as A
from corpusflow.operators.toy_analyzer import toy_analyzer_factory
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import PUNCT_SQL, token_sql
from corpusflow.plans.text_queries import documents
from corpusflow.schemas import TOKEN_COLUMNS


@register("annotate_custom", """
WITH l AS (
  SELECT doc_id + 1 AS article_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines
  FROM documents
), s AS (
  SELECT article_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS sent_id, unnest(lines) AS line FROM l
), w AS (
  SELECT article_id, sent_id, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') AS ws FROM s
), t AS (
  SELECT article_id, sent_id, CAST(generate_subscripts(ws, 1) AS INTEGER) AS id, unnest(ws) AS form FROM w
)
SELECT article_id, sent_id, id, form, lower(form) AS lemma,
       CASE WHEN regexp_matches(form, '^[0-9]+$') THEN 'NUM' ELSE 'X' END AS upos,
       '_' AS xpos, '_' AS feats, 0 AS head, 'root' AS deprel, '_' AS deps, '_' AS misc
FROM t""")
def q_annotate_custom(spark, sf):
    d = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"), "text")
    _, toks = A.process_corpus(d, toy_analyzer_factory)
    return toks.select(*TOKEN_COLUMNS)


@register("process_corpus", token_sql() + f"""
, c AS (SELECT doc_id + 1 AS article_id, translate(lower(text), {PUNCT_SQL}, '') AS cleaned FROM documents),
  n AS (SELECT article_id, count(*) AS n_tokens FROM tokens GROUP BY article_id)
SELECT c.article_id, c.cleaned, coalesce(n.n_tokens, 0) AS n_tokens
FROM c LEFT JOIN n ON n.article_id = c.article_id""")
def q_process_corpus(spark, sf):
    d = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"), "text", "lang")
    cleaned, toks = A.process_corpus(d, "rules")
    n = toks.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_tokens"))
    return cleaned.join(n, on="article_id", how="left").select(
        "article_id", "cleaned", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
