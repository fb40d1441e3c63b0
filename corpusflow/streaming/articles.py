"""Articles kept up to date as pages arrive or change (C4 upsert, U4, U9).

``run_updates`` takes the page files that have landed since the last run.  Keyed state
(url -> digest of the stored page, version, page id; RocksDB, in the query's checkpoint)
tells a new page from a changed and from an unchanged one, so a page that arrives again
as it was costs nothing behind the state.  New versions are cleaned and annotated as in
``process_corpus``, and every micro-batch writes to folders of its own
(``epoch=<id>``, overwritten when a batch is repeated):

* ``articles``  the new versions ``(url, version, page_id, digest, cleaned)``
* ``counts``    their tokens per part of speech ``(url, version, upos, n)``
* ``totals``    what changes in the corpus ``(upos, n)``: the counts of the new versions
  less those of the versions that they replace

so that readers see the newest version of each article, and corpus totals are a sum of
small deltas and never counted anew.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusflow.functions.text import LATIN_LOWER, LATIN_UPPER, clean_text
from corpusflow.operators.annotate import annotate_sentences, sentences
from corpusflow.operators.html import ARTICLE_CLASSES, parse_pages
from corpusflow.session import ship_package
from corpusflow.streaming.new_urls import ROCKSDB, page_stream

_CHANGED = "url string, version int, page_id long, digest string, html string"
_STATE = "digest string, version int, page_id long"
_SCHEMAS = {
    "articles": "url string, version int, page_id long, digest string, cleaned string, epoch long",
    "counts": "url string, version int, upos string, n long, epoch long",
    "totals": "upos string, n long, epoch long",
}


def newest_version(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The page of one URL if it differs from the stored one; of several in a batch, that of the greatest page id counts."""
    best = None
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            if best is None or (row.page_id, row.digest) > (best.page_id, best.digest):
                best = row
    digest, version, _ = state.get if state.exists else (None, 0, None)
    if best is None or best.digest == digest:
        return
    state.update((best.digest, version + 1, int(best.page_id)))
    yield pd.DataFrame({"url": [key[0]], "version": [version + 1], "page_id": [best.page_id], "digest": [best.digest], "html": [best.html]})


def changed_pages(pages: DataFrame) -> DataFrame:
    """``(url, version, page_id, digest, html)`` of the pages of a stream that are new or differ from what was seen before."""
    ship_package(pages.sparkSession)
    known = pages.filter("url is not null and page_id is not null").select(
        "url", "page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"), F.coalesce("html", F.lit("")).alias("html"))
    return known.groupBy("url").applyInPandasWithState(newest_version, _CHANGED, _STATE, "update", GroupStateTimeout.NoTimeout)


def token_counts(articles: DataFrame) -> DataFrame:
    """``(url, version, upos, n)`` of articles ``(url, version, text)``, counted inside the sentence rows first."""
    docs = articles.select(F.struct("url", "version").alias("key"), "text")
    sents = sentences(docs, id_col="key", upper=LATIN_UPPER, lower=LATIN_LOWER)
    tags = annotate_sentences(sents, lang_col=None, id_col="key", fields=("upos",))
    return tags.select("article_id.url", "article_id.version", F.explode("tokens.upos").alias("upos")) \
        .groupBy("url", "version", "upos").agg(F.count(F.lit(1)).alias("n"))


def _epochs(spark: SparkSession, base: str, table: str, before: int | None = None) -> DataFrame:
    """A table's rows; ``before``: of earlier epochs only."""
    path = os.path.join(base, table)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _SCHEMAS[table])
    rows = spark.read.schema(_SCHEMAS[table]).parquet(path)
    return rows if before is None else rows.filter(F.col("epoch") < before)


def apply_update(base: str, article_classes: tuple[str, ...] | None = ARTICLE_CLASSES) -> Callable[[DataFrame, int], None]:
    """What a micro-batch of changed pages does to the tables under ``base``.

    It reads earlier epochs only, so a repeated batch writes the same rows again.
    """
    def run(changed: DataFrame, epoch: int) -> None:
        spark = changed.sparkSession

        def write(rows: DataFrame, table: str) -> DataFrame:
            path = os.path.join(base, table, f"epoch={epoch}")
            rows.write.mode("overwrite").parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        changed = changed.persist()
        try:
            keys = changed.select("url", "version", "page_id", "digest")
            texts = parse_pages(changed.select("page_id", "url", "html"), article_classes).select("url", "text")
            new = keys.join(texts, "url")
            write(new.select("url", "version", "page_id", "digest", clean_text("text").alias("cleaned")), "articles")
            counts = write(token_counts(new), "counts")
            replaced = keys.select("url", (F.col("version") - 1).alias("version")).filter("version > 0")
            gone = _epochs(spark, base, "counts", before=epoch).join(replaced, ["url", "version"], "left_semi")
            delta = counts.select("upos", "n").unionByName(gone.select("upos", (-F.col("n")).alias("n")))
            write(delta.groupBy("upos").agg(F.sum("n").alias("n")).filter("n <> 0"), "totals")
        finally:
            changed.unpersist()
    return run


def run_updates(spark: SparkSession, source_dir: str, base: str, glob: str = "*.parquet",
                article_classes: tuple[str, ...] | None = ARTICLE_CLASSES, max_files_per_trigger: int | None = 1000) -> None:
    """Process every page file that is there now and was not before; the tables are under ``base``."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    changed = changed_pages(page_stream(spark, source_dir, glob, max_files_per_trigger))
    query = (changed.writeStream.outputMode("update").foreachBatch(apply_update(base, article_classes))
             .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()


def current_articles(spark: SparkSession, base: str) -> DataFrame:
    """``(url, version, page_id, digest, cleaned)``: the newest version of every article, found on narrow rows first."""
    rows = _epochs(spark, base, "articles")
    newest = rows.groupBy("url").agg(F.max("version").alias("version"))
    return rows.join(newest, ["url", "version"]).select("url", "version", "page_id", "digest", "cleaned")


def pos_totals(spark: SparkSession, base: str) -> DataFrame:
    """``(upos, n)`` of the whole corpus as it stands: a sum of deltas, one row per epoch and tag."""
    return _epochs(spark, base, "totals").groupBy("upos").agg(F.sum("n").alias("n")).filter("n <> 0")
