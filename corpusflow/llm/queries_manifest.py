"""Query of the dataset manifest (12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import documents
from corpusflow.llm.merkle import manifest
from corpusflow.llm.registry import register


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in fields) + ")"


# crc32 bit by bit: DuckDB has no function for it
_CRC_SQL = """crc(doc_id, rest, v) AS (
    SELECT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
    UNION ALL
    SELECT doc_id, substr(rest, 2), list_reduce(list_concat([xor(v, ord(rest[1])::BIGINT)], range(8)),
        lambda a, _: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) FROM crc WHERE rest <> '')"""

_MANIFEST_SQL = f"""
WITH RECURSIVE {_CRC_SQL},
odd AS (SELECT doc_id FROM crc WHERE rest = '' AND xor(v, 4294967295) % 2 = 0),
l AS MATERIALIZED (
    SELECT d.doc_id, coalesce('1' || source, '0') AS tree, {_leaf_sql("text")} AS leaf,
           CASE WHEN o.doc_id IS NULL THEN {_leaf_sql("text")} ELSE {_leaf_sql("replace(text, chr(10), '')")} END AS tampered,
           row_number() OVER (PARTITION BY source ORDER BY d.doc_id NULLS FIRST, leaf) - 1 AS i
    FROM documents d LEFT JOIN odd o USING (doc_id)),
a(tree, level, i, h, n) AS (
    SELECT tree, 0, i, leaf, count(*) OVER (PARTITION BY tree) FROM l
    UNION ALL
    SELECT tree, any_value(level) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM a WHERE n > 1 GROUP BY tree, i // 3),
s AS MATERIALIZED (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a WHERE n = 1),
b(level, i, h, n) AS (
    SELECT 0, i, subroot, n FROM s
    UNION ALL
    SELECT any_value(level) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM b WHERE n > 1 GROUP BY i // 3),
runs AS MATERIALIZED (
    SELECT tree, level, i // 3 AS run, list(h ORDER BY i) AS hs FROM a WHERE n > 1 GROUP BY ALL
    UNION ALL
    SELECT NULL, level, i // 3, list(h ORDER BY i) FROM b WHERE n > 1 GROUP BY ALL),
tops AS (SELECT tree, max(level) AS top FROM a GROUP BY tree),
-- every leaf's way up: first through its source's tree, then through the tree of subroots
f(serial, tree, first, level, i, h, sides) AS (
    SELECT row_number() OVER (), tree, i, 0, i, tampered, '' FROM l
    UNION ALL
    SELECT f.serial, f.tree, f.first, f.level + 1, CASE WHEN f.level < t.top THEN f.i // 3 ELSE w.run END,
           sha256(array_to_string(w.hs[:w.at], '') || f.h || array_to_string(w.hs[w.at + 2:], '')),
           f.sides || array_to_string(w.hs[:w.at], '') || array_to_string(w.hs[w.at + 2:], '')
    FROM f JOIN tops t USING (tree) JOIN s USING (tree)
    JOIN (SELECT tree, level, run, hs, unnest(range(len(hs))) AS at FROM runs) w
      ON CASE WHEN f.level < t.top THEN w.tree = f.tree AND w.level = f.level AND w.run = f.i // 3 AND w.at = f.i % 3
              ELSE w.tree IS NULL AND w.level = f.level - t.top
                   AND w.run = CASE WHEN f.level = t.top THEN s.i ELSE f.i END // 3
                   AND w.at = CASE WHEN f.level = t.top THEN s.i ELSE f.i END % 3 END),
e AS (SELECT tree, first, h, sides FROM f QUALIFY row_number() OVER (PARTITION BY serial ORDER BY level DESC) = 1)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(e.sides) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM l JOIN s USING (tree) JOIN e ON e.tree = l.tree AND e.first = l.i, (SELECT h FROM b WHERE n = 1) r
"""


@register("op12_merkle_manifest", _MANIFEST_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots, root and proofs of documents; every other row (by the checksum of its id) is folded without its line breaks."""
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(documents(spark, sf_dir), F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))))
