"""Query of the revisit operator (1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.registry import register
from corpusflow.llm.revisits import captures, resolve_revisits
from corpusflow.session import load_table

_SQL = r"""
WITH c AS (SELECT page_id, url, md5(coalesce(html, '')) AS digest, length(html) AS size, unnest([0, 1, 2]) AS crawl FROM pages),
k AS (SELECT *, page_id * 3 + crawl AS id, 1700000000 + page_id + crawl * 2592000 AS t,
             crawl = 0 OR (crawl = 1 AND page_id % 5 = 0) AS full_response,
             CASE WHEN crawl > 0 AND page_id % 5 = 0 THEN 1 ELSE 0 END AS version,
             regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\?$', '') AS bare FROM c),
p AS (SELECT *, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) AS scheme,
             lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)', 1)) AS host,
             regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*(.*)$', 1) AS rest FROM k),
r AS (SELECT *, CASE WHEN scheme = '' THEN trim(url) ELSE scheme || '://'
             || CASE WHEN scheme = 'http' THEN regexp_replace(host, ':(80)?$', '')
                     WHEN scheme = 'https' THEN regexp_replace(host, ':(443)?$', '') ELSE host END
             || CASE WHEN rest = '' THEN '/' WHEN rest LIKE '?%' THEN '/' || rest ELSE rest END END AS canonical,
             strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS date,
             CASE WHEN full_response THEN '"' || digest || '-' || version || '"'
                  WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"stale"'
                  ELSE 'W/"' || digest || '-' || version || '"' END AS etag FROM p),
o AS (SELECT canonical, t, max(id) AS original_id FROM r WHERE full_response GROUP BY canonical, t),
j AS (SELECT r.*, o.original_id FROM (SELECT * FROM r WHERE NOT full_response) r
      ASOF LEFT JOIN o ON r.canonical = o.canonical AND r.t > o.t),
m AS (SELECT j.*, s.digest AS s_digest, s.version AS s_version, s.size AS s_size, s.etag AS s_etag,
             CASE WHEN j.original_id IS NULL THEN 'no_earlier_response'
                  WHEN CASE WHEN j.etag IS NOT NULL AND s.etag IS NOT NULL
                            THEN regexp_replace(j.etag, '^W/', '') = regexp_replace(s.etag, '^W/', '')
                            ELSE j.version = s.version END THEN 'resolved'
                  ELSE 'validator_mismatch' END AS resolution
      FROM j LEFT JOIN r s ON s.id = j.original_id)
SELECT id AS record_id, canonical AS url, resolution, original_id,
       CASE WHEN resolution = 'resolved' THEN 200 END AS status,
       CASE WHEN resolution = 'resolved' THEN concat_ws('|', 'cache-control=max-age=' || (crawl * 60), 'content-length=' || s_size,
            'content-type=text/html; charset=utf-8', 'date=' || date, 'etag=' || coalesce(etag, s_etag), 'last-modified=v' || version) END AS headers,
       CASE WHEN resolution = 'resolved' THEN s_digest || '-' || s_version END AS payload_digest
FROM m
"""


@register("op1_revisit_resolution", _SQL)
def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages (three crawls derived from the table), resolved to their responses."""
    found = resolve_revisits(captures(load_table(spark, sf_dir, "pages")))
    told = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select("record_id", "url", "resolution", "original_id", "status", F.array_join(told, "|").alias("headers"), "payload_digest")
