"""Site-relative line frequency: lines on too large a share of a host's pages go.

For each host and line, the pages that hold the line are counted (a page counts
once however often it repeats the line) and divided by the pages of the host.
Lines are compared without white space at their ends, by a 128-bit hash, so that
no line's text is shuffled; lines of white space alone are neither counted nor
dropped.

Counts are summed before the shuffle, so a host with a third of all pages costs one
partial row per task and line.  The lines to drop meet the pages' hashes by an
equi-join, whose hot keys Spark splits, and each page gets back only the hashes
that it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Drop a line on more than this share of a host's pages, but only if so many pages hold it.
RATIO, MIN_PAGES = 0.1, 5
SPACE = " \t\r\x0b\x0c"


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACE))))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _solid(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """``(host, line, pages, host_pages)`` of the lines to drop; ``line`` is a hash."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).filter("host is not null")
    own = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _solid), _key))
    held = pages.select("host", F.explode(own).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return held.filter(F.col("pages") >= min_pages).join(total, "host").filter(F.col("pages") > ratio * F.col("host_pages"))


def line_dedup(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source",
               id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with the boilerplate lines taken out of the texts.

    ``chars_col``, if there is such a column, gets the new number of code points
    of the changed texts.

    Defined cases: rows without a host belong to no site, and rows without an id
    (or without text) count as pages, but all of these keep what they have; rows
    that repeat an id and a host are each a page and lose the same lines; a page
    of boilerplate alone keeps an empty text; an empty table gives no rows.
    """
    page = docs.select(F.col(id_col).alias("__id"), F.col(host_col).alias("__host"), F.col(text_col).alias("__text"))
    bad = boilerplate(docs, ratio, min_pages, host_col, text_col).select(F.col("host").alias("__host"), F.col("line").alias("__line"))
    own = F.array_distinct(F.transform(F.filter(_lines(F.col("__text")), _solid), _key))
    lost = page.filter("__id is not null and __host is not null").select("__id", "__host", F.explode(own).alias("__line")) \
        .join(bad, ["__host", "__line"]).groupBy("__id", "__host").agg(F.collect_set("__line").alias("__lost"))
    text = F.col(text_col)
    left = F.array_join(F.filter(_lines(text), lambda x: ~(_solid(x) & F.array_contains(F.col("__lost"), _key(x)))), "\n")
    changed = F.col("__lost").isNotNull() & text.isNotNull()
    out = docs.join(lost, (docs[id_col] == lost["__id"]) & (docs[host_col] == lost["__host"]), "left") \
        .withColumn(text_col, F.when(changed, left).otherwise(text))
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(changed, F.length(F.col(text_col))).otherwise(F.col(chars_col))
                             .cast(docs.schema[chars_col].dataType))
    return out.select(*docs.columns)
