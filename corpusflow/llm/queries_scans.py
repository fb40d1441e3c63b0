"""Queries of the scanning operators (2, 9, 13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import documents
from corpusflow.llm.licenses import THRESHOLD, license_scan, template_rows_sql
from corpusflow.llm.pii_bootstrap import personal_data
from corpusflow.llm.registry import register
from corpusflow.llm.secret_crf import scan


@register("op2_secret_crf")
def op2_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document: fixed patterns, and the field's additions."""
    return scan(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_model")


_LICENSE_SQL = f"""
WITH t(license, template, body) AS (VALUES {template_rows_sql()}),
u AS (
    SELECT doc_id, -1 AS line, text AS unit FROM documents WHERE contains(text, chr(10))
    UNION ALL
    SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS unit FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
w AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '[\\pL\\pN]+') AS ws FROM u),
k AS (SELECT license, template, regexp_extract_all(lower(body), '[\\pL\\pN]+') AS ws FROM t),
g AS MATERIALIZED (SELECT doc_id, line, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams
                   FROM w WHERE len(ws) > 1),
h AS MATERIALIZED (SELECT license, template, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS known
                   FROM k WHERE len(ws) > 1),
d AS (SELECT doc_id, line, license, template,
             2.0::DOUBLE * len(list_intersect(grams, known)) / (len(grams) + len(known)) AS dice
      FROM g JOIN h ON len(grams) BETWEEN 0.5 * len(known) AND 2 * len(known))
SELECT doc_id, line::INTEGER AS line, license, template, dice FROM d WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license DESC, template DESC) = 1
"""


@register("op9_license_dice", _LICENSE_SQL)
def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence templates that whole documents or their lines match."""
    return license_scan(documents(spark, sf_dir))


@register("op13_pii_bootstrap")
def op13_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document: fixed patterns, and identifiers found by their context."""
    return personal_data(documents(spark, sf_dir)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")
