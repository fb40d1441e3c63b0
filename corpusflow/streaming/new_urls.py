"""C4: incremental corpus growth with Structured Streaming.

New page files arriving in a folder are read by the file source; their links
are resolved and deduplicated by URL in streaming state (kept in the query's
checkpoint, so it survives restarts).  ``foreachBatch`` writes every
micro-batch to its own ``epoch=<id>`` folder in overwrite mode: a batch that
is replayed after a failure replaces its own output, so the table never holds
a URL twice and no batch has to read what earlier batches wrote.  The
streaming checkpoint and the output live in the shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.links import extract_links, resolve_links
from corpusflow.schemas import PAGE
from corpusflow.session import scratch_path


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(spark: SparkSession, source_dir: str, glob: str = "*.parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    # Batches may land as sub-folders (one per writer job): look inside them.
    reader = (spark.readStream.schema(PAGE).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source_dir)


def link_urls(pages: DataFrame) -> DataFrame:
    links = resolve_links(extract_links(pages))
    return links.select(F.col("url_nofrag").alias("url"))


def run_new_urls(spark: SparkSession, source_dir: str, target: str | None = None,
                 checkpoint: str | None = None, glob: str = "*.parquet",
                 within_watermark: str | None = None, max_files_per_trigger: int | None = 1000) -> str:
    """Process every page file available now, once; return the target path.

    ``within_watermark`` (an interval such as ``1 hour``) switches to
    ``dropDuplicatesWithinWatermark`` on the arrival time: bounded state, and a
    URL comes again after the interval.  Without it every URL ever seen is
    state, kept in RocksDB on the executors' disks rather than on the heap.
    A micro-batch reads at most ``max_files_per_trigger`` files; all files
    are processed, over several batches.
    """
    base = scratch_path(spark, "new-urls")
    target = target or os.path.join(base, "table")
    checkpoint = checkpoint or os.path.join(base, "checkpoint")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    urls = link_urls(page_stream(spark, source_dir, glob, max_files_per_trigger))
    if within_watermark:
        urls = (urls.withColumn("_arrival", F.current_timestamp())
                .withWatermark("_arrival", within_watermark).dropDuplicatesWithinWatermark(["url"])
                .drop("_arrival"))
    else:
        urls = urls.dropDuplicates(["url"])

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.select("url").write.mode("overwrite").parquet(os.path.join(target, f"epoch={epoch_id}"))

    q = (urls.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not _exists(spark, target):
        spark.createDataFrame([], "url string").write.mode("overwrite").parquet(
            os.path.join(target, "epoch=-1"))
    return target


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
