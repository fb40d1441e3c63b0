"""Queries of the deduplicating and fingerprinting operators (3, 7, 8, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import documents
from corpusflow.llm.line_dedup import MIN_PAGES, RATIO, line_dedup
from corpusflow.llm.ngram_join import Threshold, jaccard_join
from corpusflow.llm.order_minhash import order_minhash
from corpusflow.llm.phrase_automata import substring_dedup
from corpusflow.llm.registry import register

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_JOIN_SQL = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_transform({_WORDS},
                                  lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws
    FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 2], ' ')) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, least(len(ws), 1) + 1))) AS i FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- documents of equal sets share the hash of their sorted shingles
e AS MATERIALIZED (SELECT doc_id, md5(string_agg(g, '' ORDER BY g)) AS sig FROM s GROUP BY doc_id),
r AS MATERIALIZED (SELECT sig, min(doc_id) AS rep, count(*) AS copies FROM e GROUP BY sig),
t AS MATERIALIZED (SELECT rep, g FROM s JOIN r ON s.doc_id = r.rep),
links AS MATERIALIZED (
    SELECT a.rep AS u, b.rep AS v FROM t a JOIN t b ON a.g = b.g AND a.rep <> b.rep
    JOIN n x ON x.doc_id = a.rep JOIN n y ON y.doc_id = b.rep
    WHERE 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n
    GROUP BY a.rep, b.rep, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach(u, v) AS (SELECT rep, rep FROM r UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
c AS (SELECT u, min(v) AS component FROM reach GROUP BY u),
d AS (SELECT links.u, sum(r.copies) AS k FROM links JOIN r ON r.rep = links.v GROUP BY links.u)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(c.component, documents.doc_id) AS component_id,
       coalesce(r.copies - 1 + coalesce(d.k, 0), 0)::BIGINT AS n_links
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN r ON r.sig = e.sig
LEFT JOIN c ON c.u = r.rep LEFT JOIN d ON d.u = r.rep
"""

_PHRASE_SQL = f"""
WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w)),
again AS (SELECT doc_id, i FROM p QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS i FROM again),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
         FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w)
         ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@register("op7_ngram_jaccard_join", _JOIN_SQL)
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at Jaccard similarity 0.9 or more of their 3-word shingles."""
    return jaccard_join(documents(spark, sf_dir), k=3, limit=Threshold(90, 100))


@register("op8_repeated_phrase_automata", _PHRASE_SQL)
def op8_repeated_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words under 20-word windows that also start earlier."""
    return substring_dedup(documents(spark, sf_dir), width=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_LINES_SQL = f"""
WITH l AS (
    SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM l),
total AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
bad AS (SELECT source, key FROM k JOIN total USING (source) WHERE key <> '' GROUP BY source, key, n
        HAVING count(DISTINCT doc_id) >= {MIN_PAGES} AND count(DISTINCT doc_id) > {RATIO} * n),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM k ANTI JOIN bad USING (source, key) GROUP BY doc_id),
every AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT doc_id, every.n::BIGINT AS n_lines, length(coalesce(kept.text, ''))::BIGINT AS n_chars, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM every LEFT JOIN kept USING (doc_id)
"""


@register("op10_site_line_dedup", _LINES_SQL)
def op10_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source."""
    docs = documents(spark, sf_dir)
    before = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    kept = F.coalesce("text", F.lit(""))
    return line_dedup(before).select("doc_id", "n_lines", F.length(kept).cast("long").alias("n_chars"),
                                     F.sha2(kept, 256).alias("kept_sha256"))


@register("op3_order_minhash")
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how near they are."""
    return order_minhash(documents(spark, sf_dir))
