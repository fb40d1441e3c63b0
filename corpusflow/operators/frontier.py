"""L2: a bounded crawl frontier.  Every round fetches at most ``per_host`` URLs of each host, those found first.

The queue is a table; the round's batch is a top-k per host, taken in two steps
(within salts of a host, then over what these leave), so a host that holds a third of
the queue is no single task.  State is one table per round, as in ``operators.crawl``:
a restart goes on from the newest committed round.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpusflow.functions.urls import netloc_of
from corpusflow.operators.crawl import _done_levels
from corpusflow.session import materialize, scratch_path

_STATE = "url string, host string, found int, fetched int"
SALTS = 32


def next_batch(queue: DataFrame, per_host: int, salts: int = SALTS) -> DataFrame:
    """The rows of ``queue(url, host, found)`` whose turn it is: the first ``per_host`` of each host by round found, then by hash."""
    order = [F.asc("found"), F.xxhash64("url"), F.asc("url")]
    salt = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(salts))
    few = queue.withColumn("_salt", salt).withColumn("_rank", F.row_number().over(Window.partitionBy("host", "_salt").orderBy(*order))) \
        .filter(F.col("_rank") <= per_host)
    return few.withColumn("_rank", F.row_number().over(Window.partitionBy("host").orderBy(*order))).filter(F.col("_rank") <= per_host) \
        .drop("_salt", "_rank")


def crawl_frontier(links: DataFrame, seeds: DataFrame, per_host: int = 3, state_dir: str | None = None, max_rounds: int | None = None,
                   enough: int | None = None) -> DataFrame:
    """``(url, host, found, fetched)`` of a crawl from ``seeds(url)`` over ``links(src, dst)``.

    ``found``: the round in which a URL was first seen (0: a seed); ``fetched``: the
    round in which its links were followed, null if its turn has not come.  Rounds go on until
    the queue is empty, ``enough`` URLs are found, or ``max_rounds`` have run in this call.
    Run to the end, it finds what an unbounded crawl finds.

    Defined cases: null URLs are left out; a seed that is linked to is found in round 0; URLs
    without links are fetched like others; without seeds there is nothing.
    """
    spark = links.sparkSession
    state_dir = state_dir or scratch_path(spark, "frontier")
    root, links_path = os.path.join(state_dir, "state"), os.path.join(state_dir, "links")
    done = _done_levels(spark, root, "round=")
    if not done:
        links.select("src", "dst").filter("src is not null and dst is not null").distinct().write.mode("overwrite").parquet(links_path)
        seeds.select("url").filter("url is not null").distinct().select(
            "url", netloc_of(F.col("url")).alias("host"), F.lit(0).alias("found"), F.lit(None).cast("int").alias("fetched")) \
            .write.mode("overwrite").parquet(os.path.join(root, "round=0"))
        done = [0]
    links, at, ran = spark.read.parquet(links_path), done[-1], 0
    known = [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("fetched").isNull(), 1)).alias("waiting")]
    counts = None
    while max_rounds is None or ran < max_rounds:
        state = spark.read.schema(_STATE).parquet(os.path.join(root, f"round={at}"))
        counts = counts or state.agg(*known).first().asDict()
        if not counts["waiting"] or (enough is not None and counts["n"] >= enough):
            break
        at, ran = at + 1, ran + 1
        batch = materialize(next_batch(state.filter("fetched is null").select("url", "host", "found"), per_host).select("url"), "frontier-batch")
        seen = links.join(batch.select(F.col("url").alias("src")), "src", "left_semi").select(F.col("dst").alias("url"))
        # a URL's rows: what is known of it, that it is fetched now, that it is seen now; one aggregate, partial before its exchange
        rows = state.unionByName(batch.select("url", F.lit(at).alias("fetched")), True).unionByName(seen.select("url", F.lit(at).alias("found")), True)
        after = rows.groupBy("url").agg(F.max("host").alias("host"), F.min("found").alias("found"), F.min("fetched").alias("fetched")) \
            .select("url", F.coalesce("host", netloc_of(F.col("url"))).alias("host"), "found", "fetched")
        obs = Observation(f"frontier_{uuid.uuid4().hex[:8]}")  # counted by the job that writes
        after.observe(obs, *known).write.mode("overwrite").parquet(os.path.join(root, f"round={at}"))
        counts = obs.get
    return spark.read.schema(_STATE).parquet(os.path.join(root, f"round={at}"))
