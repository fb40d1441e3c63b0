"""Level-by-level crawl over a link table.

Each round is one DataFrame plan run by executors: frontier ⋈ links (J2)
-> new URLs -> left anti visited (J3/O3) -> union into visited (O2).  The
driver only loops and reads one count per round.  Every completed round is
written as a state table under ``state_dir`` (``round=<n>``); a restart reads
the last complete round and continues, so a stop-and-resume run gives the
same result as an uninterrupted one.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import checkpoint_dir, materialize, scratch_path


def _done_levels(spark: SparkSession, visited_root: str, prefix: str = "depth=") -> list[int]:
    """Numbers of the state tables that were committed (``_SUCCESS`` last)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(visited_root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name.split("=")[1]))
    return sorted(out)


def crawl_levels(links: DataFrame, seeds: DataFrame, state_dir: str | None = None,
                 max_rounds: int | None = None, enough: int | None = None,
                 hops_per_round: int = 8) -> DataFrame:
    """Breadth-first levels from ``seeds(url)`` over ``links(src, dst)``.

    Returns ``(url, depth)`` of every reached URL (seeds at depth 0).
    ``max_rounds`` stops after that many rounds in this call (used to test
    resume); ``enough`` stops once that many URLs are known (the crawl goal,
    checked between rounds).

    A round takes the levels after depth d up to depth t = d + max(hops_per_round, d), so a
    deep link graph takes a number of rounds that grows with the logarithm of its depth.
    Chains of URLs with one incoming link are contracted first (``_contracted``); a round
    follows the weighted links between the other URLs, ``hops_per_round`` hops from what is
    known, then reads the URLs of the chains off their distances.  Each hop adds at least
    one to the depth: a URL that takes more hops lies deeper than the least depth m that
    the last hop found.  So all levels up to min(t, m) are exact and whole, and the round
    ends there, at least ``hops_per_round`` levels on.

    State (K9): ``<state_dir>/links``, ``edges`` and ``chains=0`` (materialised once) and
    ``<state_dir>/visited/depth=<D>``, the whole visited table whose frontier
    is depth D (one compact table; a round reads one folder).  Counts come
    from ``observe`` metrics of the writing job.  A restart continues from
    the newest committed table.
    """
    spark = links.sparkSession
    if state_dir is None:
        state_dir = scratch_path(spark, "crawl")
    links_path, edges_path, chains_path = (os.path.join(state_dir, x) for x in ("links", "edges", "chains=0"))
    root = os.path.join(state_dir, "visited")
    levels = _done_levels(spark, root)
    if not levels:
        links.select("src", "dst").dropDuplicates(["src", "dst"]).write.mode("overwrite").parquet(links_path)
        (seeds.select("url").distinct().select("url", F.lit(0).alias("depth"))
         .write.mode("overwrite").parquet(os.path.join(root, "depth=0")))
        levels = [0]
    if not _done_levels(spark, state_dir, "chains="):
        lk = spark.read.parquet(links_path).filter(F.col("src").isNotNull() & ~F.col("src").eqNullSafe(F.col("dst")))
        chains, edges = _contracted(lk, spark.read.parquet(os.path.join(root, "depth=0")).select("url"))
        edges.write.mode("overwrite").parquet(edges_path)
        chains.write.mode("overwrite").parquet(chains_path)
    chains, edges = spark.read.parquet(chains_path), spark.read.parquet(edges_path)
    branching = not edges.isEmpty()
    d = levels[-1]
    done_now = 0
    while max_rounds is None or done_now < max_rounds:
        visited = spark.read.parquet(os.path.join(root, f"depth={d}"))
        if enough is not None and visited.count() >= enough:
            break
        top = d + max(hops_per_round, d)
        start = visited
        if branching:
            # What the known URLs link to beyond depth d, then what these link to.
            # Each hop is reduced to distinct URLs (partial aggregation first), so
            # a URL linked from a third of all pages reaches the next hop's
            # join as one row.
            hop, hops = visited, []
            for _ in range(hops_per_round):
                hop = (edges.join(hop.select(F.col("url").alias("a"), "depth"), on="a")
                       .select(F.col("dst").alias("url"), (F.col("depth") + F.col("w")).cast("int").alias("depth"))
                       .filter(F.col("depth").between(d + 1, top)).groupBy("url").agg(F.min("depth").alias("depth")))
                hops.append(hop.withColumn("last", F.lit(False)))
            hops[-1] = hops[-1].withColumn("last", F.lit(True))
            found = hops[0]
            for h in hops[1:]:
                found = found.unionByName(h)
            found = found.groupBy("url").agg(F.min("depth").alias("depth"), F.min(F.when(F.col("last"), F.col("depth"))).alias("ahead"))
            obs = Observation(f"crawl_hops_{uuid.uuid4().hex[:8]}")
            found = materialize(found.observe(obs, F.min("ahead").alias("ahead")), "crawl-hops").drop("ahead")
            ahead = obs.get["ahead"]
            top = top if ahead is None else min(top, ahead)
            known = visited.select(F.col("url").alias("_known"))
            start = visited.unionByName(found.join(known, F.col("url").eqNullSafe(F.col("_known")), "left_anti").filter(F.col("depth") <= top))
        chained = (chains.join(start.select(F.col("url").alias("anc"), "depth"), on="anc")
                   .select(F.col("node").alias("url"), (F.col("depth") + F.col("dist")).cast("int").alias("depth"))
                   .filter(F.col("depth").between(d + 1, top)))
        obs = Observation(f"crawl_depth_{uuid.uuid4().hex[:8]}")
        nxt = start.unionByName(chained).observe(obs, F.count(F.when(F.col("depth") == top, 1)).alias("n_front"))
        nxt.write.mode("overwrite").parquet(os.path.join(root, f"depth={top}"))
        d = top
        done_now += 1
        if not obs.get["n_front"]:
            break
    return spark.read.parquet(os.path.join(root, f"depth={d}")).select(
        "url", F.col("depth").cast("int").alias("depth"))


def bfs_levels(links: DataFrame, seeds: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """C2, analytic form: BFS depth of every URL reachable from ``seeds`` over a
    stored link table, in O(log chain length + contracted diameter) rounds.

    1. A non-seed URL with exactly one incoming link has its depth fixed by
       that predecessor (depth = depth(pred) + 1).  Such "chain" URLs are
       resolved by pointer jumping to their first ancestor that is not a chain
       URL (an "anchor"), keeping the distance; one equi-join per round doubles
       the jump.  Chains that only loop among themselves never meet an anchor
       and are unreachable.
    2. Links into anchors become weighted edges anchor(src) -> anchor with
       weight dist(src) + 1; shortest distances from the seeds over these edges
       are found by frontier Bellman-Ford rounds (only improved anchors relax).
    3. depth(chain URL) = depth(its anchor) + distance.

    Every step is a join or min-aggregate on URL keys; round state is
    checkpointed to the shared checkpoint folder and counts come from
    ``observe`` metrics of the checkpointing job.  The relaxation ends when no
    distance changes; a given ``max_rounds`` that is reached before raises.
    """
    spark = links.sparkSession
    checkpoint_dir(spark)
    e = links.select("src", "dst").filter(F.col("src") != F.col("dst")).dropDuplicates(["src", "dst"])
    s = seeds.select("url").distinct()
    resolved, cedges = _contracted(e, s)
    dist, _ = _observed_checkpoint(s.select(F.col("url").alias("a"), F.lit(0).cast("bigint").alias("d"),
                                            F.lit(True).alias("changed")), F.count(F.lit(1)).alias("n"))
    relaxed = 0
    while True:
        if max_rounds is not None and relaxed >= max_rounds:
            raise RuntimeError(f"distances still change after {max_rounds} rounds")
        relaxed += 1
        front = dist.filter("changed").select("a", "d")
        cand = (front.join(cedges, on="a").select(F.col("dst").alias("a"), (F.col("d") + F.col("w")).alias("nd")))
        best = cand.groupBy("a").agg(F.min("nd").alias("nd"))
        j = dist.select("a", "d").join(best, on="a", how="full_outer")
        better = F.col("nd").isNotNull() & (F.col("d").isNull() | (F.col("nd") < F.col("d")))
        nxt = j.select("a", F.when(better, F.col("nd")).otherwise(F.col("d")).alias("d"),
                       better.alias("changed"))
        dist, m = _observed_checkpoint(nxt, F.sum(F.col("changed").cast("int")).alias("n_changed"))
        if not m["n_changed"]:
            break
    anchors = dist.select(F.col("a").alias("url"), F.col("d").alias("depth"))
    chained = resolved.join(dist.select(F.col("a").alias("anc"), F.col("d")), on="anc", how="inner").select(
        F.col("node").alias("url"), (F.col("d") + F.col("dist")).alias("depth"))
    return anchors.unionByName(chained).select("url", F.col("depth").cast("int").alias("depth"))


def _contracted(e: DataFrame, s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps 1 and 2 of ``bfs_levels`` for distinct links ``e(src, dst)`` without loops and seeds ``s(url)``:
    chain URLs ``(node, anc, dist)`` that meet an anchor, and weighted edges ``(a, dst, w)`` between anchors."""
    indeg = e.groupBy("dst").agg(F.count(F.lit(1)).alias("k"), F.min("src").alias("pred"))
    chain = (indeg.filter((F.col("k") == 1) & F.col("dst").isNotNull()).join(s, indeg["dst"] == s["url"], "left_anti")
             .select(F.col("dst").alias("node"), F.col("pred").alias("anc"),
                     F.lit(1).cast("bigint").alias("dist")))
    state = _observed_checkpoint(chain, F.count(F.lit(1)).alias("n"))
    n_chain, state = state[1]["n"], state[0]
    nodes = state.select(F.col("node").alias("anc"), F.lit(True).alias("_chain"))
    rounds = 0
    limit = max(1, int(n_chain).bit_length() + 1)
    while True:
        look = state.select(F.col("node").alias("anc"), F.col("anc").alias("anc2"), F.col("dist").alias("dist2"))
        j = state.join(look, on="anc", how="left")
        moved = F.col("anc2").isNotNull()
        nxt = j.select("node", F.when(moved, F.col("anc2")).otherwise(F.col("anc")).alias("anc"),
                       F.when(moved, F.col("dist") + F.col("dist2")).otherwise(F.col("dist")).alias("dist"))
        nxt = nxt.join(nodes, on="anc", how="left")
        state, m = _observed_checkpoint(
            nxt.select("node", "anc", "dist", F.coalesce("_chain", F.lit(False)).alias("open")),
            F.sum(F.col("open").cast("int")).alias("n_open"))
        rounds += 1
        if not m["n_open"] or rounds >= limit:
            break
        state = state.drop("open")
    # Rows still pointing at a chain URL sit on (or below) a cycle without anchor.
    resolved = state.filter(~F.col("open")).select("node", "anc", "dist")
    # Weighted edges between anchors.
    chain_nodes = state.select(F.col("node").alias("src"))
    into_anchor = e.join(state.select(F.col("node").alias("dst")), on="dst", how="left_anti")
    from_chain = into_anchor.join(resolved.select(F.col("node").alias("src"), F.col("anc").alias("a"),
                                                  F.col("dist").alias("w0")), on="src", how="inner")
    from_anchor = into_anchor.join(chain_nodes, on="src", how="left_anti").select(
        F.col("src").alias("a"), "dst", F.lit(0).cast("bigint").alias("w0"))
    cedges = (from_chain.select("a", "dst", "w0").unionByName(from_anchor)
              .groupBy("a", "dst").agg((F.min("w0") + 1).alias("w")))
    cedges, _ = _observed_checkpoint(cedges, F.count(F.lit(1)).alias("n"))
    return resolved, cedges


def _observed_checkpoint(df: DataFrame, *metrics):
    """Reliable checkpoint of ``df`` (shared folder) and the observed metrics of
    the job that wrote it."""
    obs = Observation(f"cf_{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, *metrics).checkpoint(eager=True)
    return out, obs.get


def crawl_pages(pages: DataFrame, seeds: DataFrame, marks: list[str] | None = None,
                url_pattern: str | None = None, enough: int | None = None, state_dir: str | None = None,
                max_rounds: int | None = None) -> DataFrame:
    """C2 / C3 over stored pages: fetch, extract links, keep the site's own, tell articles from
    navigation, go on with both, until nothing new turns up or ``enough`` articles are found.

    ``seeds(url, seed_order)``; ``pages(page_id, url, html[, status])``: pages whose
    status is no success are found but not fetched.  Returns ``(url, kind, depth,
    place)`` of every URL found (seeds excluded), ``place`` being its number in
    discovery order: by depth, then the place of the page that links to it first,
    then the position of the link.  ``kind`` is ``article`` or ``navigation``;
    an article must match ``url_pattern`` if one is given, other links are
    dropped.  With ``enough`` the rounds stop once that many articles are found,
    and articles beyond them in discovery order are left out.

    Links are extracted in one pass over the pages, so no round touches HTML.  A
    round joins the URLs found in the last one to their links, takes each new
    URL's first sighting (a min-aggregate, partial before the shuffle) and
    writes only the new rows, under ``<state_dir>/found/round=<n>``.  A restart
    with the same ``state_dir`` goes on from the newest committed round
    (``max_rounds`` stops a call early, to resume later).
    """
    from corpusflow.functions.urls import strip_fragment
    from corpusflow.operators.links import assign_ids, classified_links, fetchable, first_seen

    spark = pages.sparkSession
    state_dir = state_dir or scratch_path(spark, "crawl-pages")
    root, links_path = os.path.join(state_dir, "found"), os.path.join(state_dir, "links")
    schema = "url string, kind string, depth int, place long"
    done = _done_levels(spark, root, "round=")
    if not done:
        links = classified_links(fetchable(pages).select("page_id", "url", "html"), marks)
        if url_pattern is not None:
            links = links.filter((F.col("kind") != "article") | F.col("url").rlike(url_pattern))
        links.select(strip_fragment(F.col("seed")).alias("src"), "url", "kind", "page_id", "pos") \
            .write.mode("overwrite").parquet(links_path)
        start = assign_ids(seeds.select(strip_fragment(F.col("url")).alias("url"), "seed_order")
                           .groupBy("url").agg(F.min("seed_order").alias("seed_order")), ["seed_order", "url"], "place")
        start.select("url", F.lit("seed").alias("kind"), F.lit(0).alias("depth"), F.col("place").cast("long").alias("place")) \
            .write.mode("overwrite").parquet(os.path.join(root, "round=0"))
        done = [0]
    links = spark.read.parquet(links_path)
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        at = done[-1]
        found = spark.read.schema(schema).parquet(*[os.path.join(root, f"round={r}") for r in done])
        last = found.filter(F.col("depth") == at)
        n_articles, highest, n_last = found.agg(
            F.count(F.when(F.col("kind") == "article", 1)), F.max("place"), F.count(F.when(F.col("depth") == at, 1))).first()
        if not n_last or (enough is not None and n_articles >= enough):
            break
        new = links.join(last.select(F.col("url").alias("src"), F.col("place").alias("from")), on="src") \
            .select("url", "from", "page_id", "pos", "kind")
        new = first_seen(new, "url", ["from", "page_id", "pos"]).join(found.select("url"), on="url", how="left_anti")
        placed = assign_ids(new, ["from", "page_id", "pos", "url"], "place").select(
            "url", "kind", F.lit(at + 1).alias("depth"), (F.col("place") + highest).cast("long").alias("place"))
        placed.write.mode("overwrite").parquet(os.path.join(root, f"round={at + 1}"))
        done.append(at + 1)
        rounds += 1
    found = spark.read.schema(schema).parquet(*[os.path.join(root, f"round={r}") for r in done]).filter("kind <> 'seed'")
    if enough is None:
        return found
    articles = found.filter("kind = 'article'").orderBy("place").limit(enough)
    return articles.unionByName(found.filter("kind <> 'article'"))


def host_chain_links(pages: DataFrame) -> DataFrame:
    """The derived link graph of the stored pages: each page links to the next
    page of its host (in ``page_id`` order).  Built from global sequence
    numbers, so a host holding a third of all pages is not one task."""
    from corpusflow.functions.urls import netloc_of
    from corpusflow.operators.graph import sequence_edges
    p = pages.select("page_id", "url", netloc_of(F.col("url")).alias("host"))
    e = sequence_edges(p, "host", ["page_id"], "page_id", {"next": 1})
    urls = p.select("page_id", "url")
    return (e.join(urls.withColumnRenamed("page_id", "src").withColumnRenamed("url", "src_url"), on="src")
            .join(urls.withColumnRenamed("page_id", "dst").withColumnRenamed("url", "dst_url"), on="dst")
            .select(F.col("src_url").alias("src"), F.col("dst_url").alias("dst")))


def host_seeds(pages: DataFrame) -> DataFrame:
    """First page of every host (a min-by aggregate, partial before the shuffle)."""
    from corpusflow.functions.urls import netloc_of
    p = pages.select(netloc_of(F.col("url")).alias("host"), F.struct("page_id", "url").alias("p"))
    return p.groupBy("host").agg(F.min("p").alias("p")).select(F.col("p.url").alias("url"))
