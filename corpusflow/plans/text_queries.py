"""Queries over ``documents``: cleaning, sentences, rule annotation, POS stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import annotate as A
from corpusflow.operators import stats as S
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import PUNCT_SQL, sentences_cte, token_sql
from corpusflow.session import load_table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "documents")


def doc_tokens(spark: SparkSession, sf: str, with_text: bool = False) -> DataFrame:
    return A.annotate_documents(documents(spark, sf), with_text=with_text)


@register("clean_text", f"""
SELECT doc_id + 1 AS article_id, translate(lower(text), {PUNCT_SQL}, '') AS cleaned
FROM documents""")
def q_clean_text(spark, sf):
    d = documents(spark, sf)
    return d.select((F.col("doc_id") + 1).alias("article_id"), T.clean_text("text").alias("cleaned"))


@register("split_sentences", "WITH " + sentences_cte().lstrip() + """
SELECT article_id, sent_id, sentence FROM sents""")
def q_split_sentences(spark, sf):
    d = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"), "text")
    return A.sentences(d, upper=T.LATIN_UPPER, lower=T.LATIN_LOWER)


@register("annotate_rules", token_sql() + """
SELECT * FROM tokens""")
def q_annotate_rules(spark, sf):
    return doc_tokens(spark, sf)


@register("pos_frequencies", token_sql() + """
SELECT article_id, upos, count(*) AS n FROM tokens GROUP BY article_id, upos""")
def q_pos_frequencies(spark, sf):
    return S.pos_frequencies(doc_tokens(spark, sf))


def doc_sentences_and_tokens(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"), "text", "lang")
    sents = A.sentences(d, upper=T.LATIN_UPPER, lower=T.LATIN_LOWER, keep=("lang",))
    return sents, A.annotate_rules(sents)


_COUNTS = """
, counts AS (
  SELECT article_id, upos, count(*) AS n, min(sent_id * 1000000 + id) AS fp
  FROM tokens GROUP BY article_id, upos
), ranked AS (
  SELECT article_id, upos, n, fp,
         CAST(row_number() OVER (PARTITION BY article_id ORDER BY n DESC, fp) AS INTEGER) AS rank
  FROM counts
)"""


@register("pos_frequency_map", token_sql() + _COUNTS + """
SELECT article_id, '{' || string_agg('"' || upos || '":' || n, ',' ORDER BY fp) || '}' AS pos_json
FROM counts GROUP BY article_id""")
def q_pos_frequency_map(spark, sf):
    return S.pos_frequency_map(doc_tokens(spark, sf)).select("article_id", "pos_json")


@register("pos_ranking", token_sql() + _COUNTS + """
SELECT article_id, upos, n, rank FROM ranked""")
def q_pos_ranking(spark, sf):
    return S.pos_ranking(doc_tokens(spark, sf))


@register("top_pos_tags", token_sql() + _COUNTS + """
SELECT article_id, upos, n, rank FROM ranked WHERE rank <= 3""")
def q_top_pos_tags(spark, sf):
    return S.top_pos_tags(doc_tokens(spark, sf), 3)


@register("pos_chart_rows", token_sql() + _COUNTS + """
SELECT article_id, rank, upos, n,
       ['b', 'g', 'r', 'c'][((rank - 1) % 4) + 1] AS colour,
       max(n) OVER (PARTITION BY article_id) + 1 AS y_limit
FROM ranked""")
def q_pos_chart_rows(spark, sf):
    return S.pos_chart_rows(doc_tokens(spark, sf))


@register("pos_report", token_sql() + _COUNTS + """
, fm AS (
  SELECT article_id, '{' || string_agg('"' || upos || '":' || n, ',' ORDER BY fp) || '}' AS pos_json
  FROM counts GROUP BY article_id
)
SELECT d.doc_id + 1 AS article_id, d.lang, d.n_chars, fm.pos_json
FROM documents d LEFT JOIN fm ON fm.article_id = d.doc_id + 1""")
def q_pos_report(spark, sf):
    toks = doc_tokens(spark, sf)
    arts = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"), "lang", "n_chars")
    return S.pos_report(toks, arts).select(
        "article_id", "lang", "n_chars", F.to_json("pos_frequencies").alias("pos_json"))


@register("clean_tokens", f"""
SELECT doc_id + 1 AS article_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS token
FROM (SELECT doc_id, list_filter(regexp_split_to_array(translate(lower(text), {PUNCT_SQL}, ''), '\\s+'),
                                 lambda x: x <> '') AS l FROM documents)""")
def q_clean_tokens(spark, sf):
    d = documents(spark, sf)
    return d.select((F.col("doc_id") + 1).alias("article_id"),
                    F.posexplode(T.whitespace_tokens(T.clean_text("text"))).alias("pos", "token"))


@register("clean_text_lint", f"""
WITH c AS (
  SELECT doc_id + 1 AS article_id, translate(lower(text), {PUNCT_SQL}, '') AS cleaned FROM documents
), t AS (
  SELECT article_id, cleaned,
         list_filter(regexp_split_to_array(cleaned, '\\s+'), lambda x: x <> '') AS toks FROM c
)
SELECT article_id,
  regexp_matches(cleaned, '[!-/:-@\\[-`{{-~]') AS has_punct,
  len(list_filter(toks, lambda x: regexp_matches(x, '^[!-/:-@\\[-`{{-~]+$'))) > 0 AS punct_only_token,
  len(list_filter(toks, lambda x: regexp_matches(x, '^\\p{{L}}+$') AND x <> lower(x))) > 0 AS upper_alpha_token,
  cleaned = translate(lower(cleaned), {PUNCT_SQL}, '') AS idempotent
FROM t""")
def q_clean_text_lint(spark, sf):
    d = documents(spark, sf).select((F.col("doc_id") + 1).alias("article_id"),
                                    T.clean_text("text").alias("cleaned"))
    toks = T.whitespace_tokens(F.col("cleaned"))
    punct_only = "^" + T.punct_class_regex() + "+$"
    return d.select(
        "article_id",
        T.has_punctuation("cleaned").alias("has_punct"),
        F.exists(toks, lambda x: x.rlike(punct_only)).alias("punct_only_token"),
        F.exists(toks, lambda x: x.rlike(r"^\p{L}+$") & (x != F.lower(x))).alias("upper_alpha_token"),
        (F.col("cleaned") == T.clean_text("cleaned")).alias("idempotent"))


@register("short_texts", """
SELECT doc_id + 1 AS article_id, length(text) AS n_chars FROM documents WHERE length(text) <= 5""")
def q_short_texts(spark, sf):
    d = documents(spark, sf)
    return d.filter(T.is_short_text("text")).select(
        (F.col("doc_id") + 1).alias("article_id"), F.length("text").cast("bigint").alias("n_chars"))


@register("duplicate_texts", """
SELECT sha256(text) AS text_sha256, count(*) AS n_copies, min(doc_id) + 1 AS first_article_id
FROM documents GROUP BY sha256(text) HAVING count(*) > 1""")
def q_duplicate_texts(spark, sf):
    return S.duplicate_texts(documents(spark, sf).select(
        (F.col("doc_id") + 1).alias("article_id"), "text"))
