"""Corpus scan, meta, file-name and validation queries.

The driver tables stand in for the on-disk corpus: ``documents`` rows are the
raw files (``article_id = doc_id + 1``, length = ``n_chars``) and ``labels``
rows the meta files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import paths as P
from corpusflow.functions.text import clean_text
from corpusflow.operators import validate as V
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import PUNCT_SQL
from corpusflow.session import load_table, scratch_path
from corpusflow.sinks import files as K
from corpusflow.sinks.files import meta_json
from corpusflow.sources import corpus_source as C
from corpusflow.sources import files as S

_FILES_SQL = """
files AS (
  SELECT CAST(doc_id + 1 AS VARCHAR) || '_raw.txt' AS name, n_chars AS length,
         doc_id + 1 AS file_id, 'raw' AS kind FROM documents
  UNION ALL
  SELECT CAST(doc_id + 1 AS VARCHAR) || '_meta.json' AS name,
         CAST(length(to_json({'doc_id': doc_id, 'quality': quality, 'toxic': toxic})) AS BIGINT) AS length,
         doc_id + 1 AS file_id, 'meta' AS kind FROM labels
)"""


def corpus_files(spark, sf):
    docs = load_table(spark, sf, "documents").select(
        F.concat((F.col("doc_id") + 1).cast("string"), F.lit("_raw.txt")).alias("name"),
        F.col("n_chars").alias("length"))
    metas = load_table(spark, sf, "labels").select(
        F.concat((F.col("doc_id") + 1).cast("string"), F.lit("_meta.json")).alias("name"),
        F.length(F.to_json(F.struct("doc_id", "quality", "toxic"))).alias("length"))
    return V.file_rows(docs.unionByName(metas))


@register("scan_raw", "SELECT doc_id + 1 AS article_id, text FROM documents")
def q_scan_raw(spark, sf):
    # the texts as the corpus holds them, written and read back by the corpus source
    docs = load_table(spark, sf, "documents").select((F.col("doc_id") + 1).alias("article_id"), "text")
    path = scratch_path(spark, "raw")
    K.write_raw(docs, path)
    return S.read_raw_table(spark, path)


_META_DOCS_SQL = """
SELECT doc_id + 1 AS id, 'https://corpus.example/' || source || '/' || CAST(doc_id + 1 AS VARCHAR) AS url,
       CASE WHEN lang = 'de' THEN '' ELSE lang END AS title, CAST(NULL AS VARCHAR) AS date,
       CAST(to_json([source]) AS VARCHAR) AS author, CAST(to_json([lang]) AS VARCHAR) AS topics
FROM documents"""


@register("scan_meta", _META_DOCS_SQL)
def q_scan_meta(spark, sf):
    d = load_table(spark, sf, "documents")
    # Meta JSON as a writer would produce it; a null title is left out of the
    # JSON, so reading it back must apply the default.
    js = d.select(F.to_json(F.struct(
        (F.col("doc_id") + 1).alias("id"),
        F.concat(F.lit("https://corpus.example/"), F.col("source"), F.lit("/"),
                 (F.col("doc_id") + 1).cast("string")).alias("url"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("title"),
        F.array("source").alias("author"), F.array("lang").alias("topics"))).alias("meta_json"))
    m = S.parse_meta_json(js)
    return m.select("id", "url", "title", "date", F.to_json("author").alias("author"),
                    F.to_json("topics").alias("topics"))


@register("scan_corpus", """
SELECT d.doc_id + 1 AS article_id, d.text, d.lang, l.quality, l.toxic
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def q_scan_corpus(spark, sf):
    raw = load_table(spark, sf, "documents").select(
        (F.col("doc_id") + 1).alias("article_id"), "text", "lang")
    meta = load_table(spark, sf, "labels").select(
        (F.col("doc_id") + 1).alias("article_id"), "quality", "toxic")
    return S.scan_corpus(raw, meta)


@register("meta_json", """
SELECT doc_id + 1 AS id, CAST(to_json({'id': doc_id + 1, 'url': NULL::VARCHAR, 'title': source,
  'date': NULL::VARCHAR, 'author': ['NOT FOUND'], 'topics': [lang],
  'pos_frequencies': MAP {}::MAP(VARCHAR, BIGINT), 'pattern_matches': MAP {}::MAP(VARCHAR, VARCHAR)}) AS VARCHAR) AS meta
FROM documents""")
def q_meta_json(spark, sf):
    d = load_table(spark, sf, "documents").select(
        (F.col("doc_id") + 1).alias("article_id"), F.col("source").alias("title"),
        F.array(F.lit("NOT FOUND")).alias("author"), F.array("lang").alias("topics"))
    return d.select(F.col("article_id").alias("id"), meta_json(d).alias("meta"))


@register("artifact_names", """
SELECT doc_id + 1 AS article_id, k.kind,
  CAST(doc_id + 1 AS VARCHAR) || CASE k.kind WHEN 'raw' THEN '_raw.txt' WHEN 'meta' THEN '_meta.json'
    WHEN 'cleaned' THEN '_cleaned.txt' WHEN 'udpipe' THEN '_udpipe.conllu' END AS name
FROM documents, (VALUES ('raw'), ('meta'), ('cleaned'), ('udpipe')) AS k(kind)""")
def q_artifact_names(spark, sf):
    d = load_table(spark, sf, "documents").select(
        (F.col("doc_id") + 1).alias("article_id"),
        F.explode(F.array(*[F.lit(k) for k in P.ARTIFACT_SUFFIX])).alias("kind"))
    return d.select("article_id", "kind", P.artifact_name(F.col("article_id"), F.col("kind")).alias("name"))


_NAME_PATTERNS = ["{}_raw.txt", "{}_meta.json", "{}_cleaned.txt", "{}_udpipe.conllu",
                  "{}_image.png", "{}_corrupted.txt", "raw_{}.txt", "{}_raw.txt.bak"]


@register("corpus_file_filter", """
WITH n AS (
  SELECT unnest([""" + ", ".join(
    "'" + p.split("{}")[0] + "' || CAST(doc_id + 1 AS VARCHAR) || '" + p.split("{}")[1] + "'"
    for p in _NAME_PATTERNS) + """]) AS name FROM documents
)
SELECT name, regexp_matches(name, '""" + P.CORPUS_FILE_REGEX + """') AS recognised,
  CASE WHEN regexp_matches(name, '""" + P.CORPUS_FILE_REGEX + """')
       THEN regexp_extract(name, '^[0-9]+_([a-z]+)\\.', 1) END AS kind
FROM n""")
def q_corpus_file_filter(spark, sf):
    ident = (F.col("doc_id") + 1).cast("string")
    names = [F.concat(F.lit(p.split("{}")[0]), ident, F.lit(p.split("{}")[1])) for p in _NAME_PATTERNS]
    d = load_table(spark, sf, "documents").select(F.explode(F.array(*names)).alias("name"))
    return d.select("name", P.is_corpus_file(F.col("name")).alias("recognised"),
                    P.corpus_file_kind(F.col("name")).alias("kind"))


@register("files_by_kind", "WITH " + _FILES_SQL.lstrip() + """
SELECT kind, count(*) AS n_files FROM files GROUP BY kind""")
def q_files_by_kind(spark, sf):
    return V.files_by_kind(corpus_files(spark, sf))


@register("id_gap_check", "WITH " + _FILES_SQL.lstrip() + """
SELECT kind, count(*) AS n, count(DISTINCT file_id) AS n_distinct, min(file_id) AS min_id,
       max(file_id) AS max_id,
       NOT (count(*) = max(file_id) AND count(DISTINCT file_id) = count(*) AND min(file_id) = 1) AS has_gaps
FROM files GROUP BY kind""")
def q_id_gap_check(spark, sf):
    return V.id_stats(corpus_files(spark, sf))


@register("missing_ids", """
SELECT r.range AS missing_id FROM range(1, (SELECT max(doc_id + 1) FROM labels) + 1) r
WHERE r.range NOT IN (SELECT doc_id + 1 FROM labels)""")
def q_missing_ids(spark, sf):
    ids = load_table(spark, sf, "labels").select((F.col("doc_id") + 1).alias("file_id"))
    return V.missing_ids(ids)


@register("raw_meta_balance", "WITH " + _FILES_SQL.lstrip() + """
, r AS (SELECT DISTINCT file_id FROM files WHERE kind = 'raw'),
  m AS (SELECT DISTINCT file_id FROM files WHERE kind = 'meta')
SELECT coalesce(r.file_id, m.file_id) AS article_id, r.file_id IS NOT NULL AS has_raw,
       m.file_id IS NOT NULL AS has_meta
FROM r FULL OUTER JOIN m ON r.file_id = m.file_id
WHERE r.file_id IS NULL OR m.file_id IS NULL""")
def q_raw_meta_balance(spark, sf):
    return V.raw_meta_balance(corpus_files(spark, sf))


@register("validate_corpus", "WITH " + _FILES_SQL.lstrip() + """
, a AS (
  SELECT count(*) AS n_all, count(*) FILTER (WHERE kind = 'raw') AS n_raw,
    count(*) FILTER (WHERE kind = 'meta') AS n_meta,
    max(file_id) FILTER (WHERE kind = 'raw') AS max_raw, max(file_id) FILTER (WHERE kind = 'meta') AS max_meta,
    min(file_id) FILTER (WHERE kind = 'raw') AS min_raw, min(file_id) FILTER (WHERE kind = 'meta') AS min_meta,
    count(DISTINCT file_id) FILTER (WHERE kind = 'raw') AS d_raw,
    count(DISTINCT file_id) FILTER (WHERE kind = 'meta') AS d_meta
  FROM files
)
SELECT 'V3_empty_file' AS rule, kind, name AS detail FROM files WHERE length = 0
UNION ALL SELECT 'V4_empty_directory', NULL, 'no corpus files' FROM a WHERE n_all = 0
UNION ALL SELECT 'V5_no_raw_files', 'raw', 'no raw files' FROM a WHERE n_all > 0 AND n_raw = 0
UNION ALL SELECT 'V5_no_meta_files', 'meta', 'no meta files' FROM a WHERE n_all > 0 AND n_meta = 0
UNION ALL SELECT 'V6_unequal_counts', NULL, 'raw=' || n_raw || ' meta=' || n_meta FROM a WHERE n_raw <> n_meta
UNION ALL SELECT 'V7_raw_id_gaps', 'raw', 'n=' || n_raw || ' max=' || coalesce(CAST(max_raw AS VARCHAR), '')
  FROM a WHERE n_raw > 0 AND NOT (max_raw = n_raw AND d_raw = n_raw AND min_raw = 1)
UNION ALL SELECT 'V7_meta_id_gaps', 'meta', 'n=' || n_meta || ' max=' || coalesce(CAST(max_meta AS VARCHAR), '')
  FROM a WHERE n_meta > 0 AND NOT (max_meta = n_meta AND d_meta = n_meta AND min_meta = 1)""")
def q_validate_corpus(spark, sf):
    return V.validate_corpus(corpus_files(spark, sf))


@register("corpus_file_roundtrip", """
SELECT doc_id + 1 AS article_id, kind, name, CAST(strlen(text) AS BIGINT) AS length, text FROM (
  SELECT doc_id, 'raw' AS kind, CAST(doc_id + 1 AS VARCHAR) || '_raw.txt' AS name, text FROM documents
  UNION ALL
  SELECT doc_id, 'cleaned', CAST(doc_id + 1 AS VARCHAR) || '_cleaned.txt', """ + f"translate(lower(text), {PUNCT_SQL}, '')" + """ FROM documents)
WHERE text IS NOT NULL""")
def q_corpus_file_roundtrip(spark, sf):
    # K3 + K4 + K6: one file per article and kind, read back by the corpus source
    docs = load_table(spark, sf, "documents").select((F.col("doc_id") + 1).alias("article_id"), "text")
    path = scratch_path(spark, "corpus-files")
    C.write_files(C.article_files(docs, raw=F.col("text"), cleaned=clean_text("text")), path)
    return C.read_files(spark, path, ("raw", "cleaned")).select("article_id", "kind", "name", "length", "text")


@register("list_corpus_files")
def q_list_corpus_files(spark, sf):
    return S.list_files(spark, sf, "*.parquet").select("name", "length")


@register("article_id_from_path", f"""
SELECT name, TRY_CAST(split_part(regexp_replace(name, '(.)\\.[^.]*$', '\\1'), '_', 1) AS BIGINT) AS article_id
FROM (SELECT unnest([CAST(doc_id + 1 AS VARCHAR) || '_raw.txt', CAST(doc_id + 1 AS VARCHAR) || '_udpipe.conllu',
                     'x' || CAST(doc_id AS VARCHAR) || '_meta.json']) AS name FROM documents)""")
def q_article_id_from_path(spark, sf):
    ident = (F.col("doc_id") + 1).cast("string")
    names = F.array(F.concat(ident, F.lit("_raw.txt")), F.concat(ident, F.lit("_udpipe.conllu")),
                    F.concat(F.lit("x"), F.col("doc_id").cast("string"), F.lit("_meta.json")))
    d = load_table(spark, sf, "documents").select(F.explode(names).alias("name"))
    return d.select("name", P.article_id_from_name(F.col("name")).alias("article_id"))


def _meta_with_wrong_ids(spark, sf):
    """Meta records of the documents, as JSON text read back; every fiftieth holds its successor's id."""
    d = load_table(spark, sf, "documents")
    own = F.col("doc_id") + F.when(F.col("doc_id") % 50 == 0, 2).otherwise(1)
    js = d.select((F.col("doc_id") + 1).alias("article_id"), F.to_json(F.struct(own.alias("id"), F.col("source").alias("title"))).alias("meta_json"))
    return S.parse_meta_json(js)


@register("duplicate_meta_ids", """
SELECT id, count(*) AS n FROM (SELECT doc_id + CASE WHEN doc_id % 50 = 0 THEN 2 ELSE 1 END AS id FROM documents)
GROUP BY id HAVING count(*) > 1""")
def q_duplicate_meta_ids(spark, sf):
    return V.duplicate_ids(_meta_with_wrong_ids(spark, sf))


@register("meta_id_mismatch", """
SELECT doc_id + 1 AS article_id, doc_id + 2 AS id FROM documents WHERE doc_id % 50 = 0""")
def q_meta_id_mismatch(spark, sf):
    return V.id_mismatches(_meta_with_wrong_ids(spark, sf))
