"""Query of the phrase collocations (11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm.collocations import collocations
from corpusflow.llm.common import documents
from corpusflow.llm.registry import register

_SQL = """
WITH p AS MATERIALIZED (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
t AS MATERIALIZED (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
    SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS MATERIALIZED (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (
    SELECT lang, phrase, size, f AS a, ws, unnest(range(1, size)) AS k FROM f WHERE size > 1),
s AS (
    SELECT c.lang, c.phrase, c.size, c.a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, sub, max(f) AS f FROM (
        SELECT lang, f, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS sub FROM f WHERE size = 3) GROUP BY lang, sub)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, t.n, b.score
FROM b JOIN t USING (lang) LEFT JOIN longer ON longer.lang = b.lang AND longer.sub = b.phrase
WHERE longer.f IS NULL OR 100 * longer.f < 50 * b.a
QUALIFY rank <= 2000
"""


@register("op11_phrase_collocations", _SQL)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two and three words."""
    return collocations(documents(spark, sf_dir))
