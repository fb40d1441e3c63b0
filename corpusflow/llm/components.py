"""Connected components of a link table, by alternating large and small stars.

Every step is a min-aggregate (partial on the map side) and an equi-join of
two-column rows, so a hub with a third of all links is split like any skewed
join side.  Rounds are written to the shared checkpoint folder; the number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged


#: Links that one task of a round handles; a round of few links runs few tasks.
TASK_LINKS = 100_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .filter("u <> v").coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").coalesce(tasks) \
        .unionAll(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)``; the component is its least node.

    Links to itself and repeated links are allowed and add nothing; a link with a
    null end is ignored; no links give no rows.
    """
    at = staged(edges.select("u", "v").filter("u <> v").distinct(), label)
    state, count = None, at.count()
    while True:
        tasks = max(6, -(-2 * count // TASK_LINKS))
        at = staged(_small_star(_large_star(at, tasks), tasks), label)
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, count = now, now[0]
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionAll(at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
