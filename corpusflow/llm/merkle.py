"""Merkle manifest of a table: a tree of fan-out FAN over the rows of every source, and one over the sources.

The nodes of a tree are an append log in postorder.  Aligned builders each take a
run of FAN**span nodes of one level, append every node to the log the moment its
children are complete, and hand the root of their run to the builders above.
Where a node stands in the log follows from the number of leaves alone
(``position``), so builders need not know of each other, and a proof addresses a
node's siblings in the log by their places without searching or links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import shuffle_partitions, staged, workers_ready

FAN = 3
#: Levels that one builder spans: it holds at most FAN**SPAN nodes of its lowest level.
SPAN = 8
_HEX = 64
_LOG = ("tree string, n long, tier int, block long, level int, index long, position long, digest string")
_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def node_hash(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes of a level in a tree of n leaves."""
    return -(-n // FAN ** level)


def height(n: int) -> int:
    """The level of the root in a tree of n leaves."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def position(level: int, index: int, n: int, top: int) -> int:
    """Place from 0 of a node in the postorder log of a tree of n leaves and height ``top``.

    Before a node come, of its own and lower levels, all that end where it ends,
    and of higher levels those that end where it begins.
    """
    first = index * FAN ** level
    end = min(first + FAN ** level, n)
    return sum(width(end, g) for g in range(level + 1)) + sum(first // FAN ** g for g in range(level + 1, top + 1)) - 1


def grow(digests: list[str], level: int, first: int, n: int, top: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the nodes over a run of ``level``'s nodes from ``first``, up to level ``top``, as they become complete."""
    runs: list[list[str]] = [[] for _ in range(level, top + 1)]
    widths = [width(n, g) for g in range(level, top + 1)]
    for at, node in enumerate(digests, first):
        for h, run in enumerate(runs):
            yield level + h, at, node
            run.append(node)
            if level + h == top or (len(run) < FAN and at + 1 < widths[h]):
                break
            node = node_hash(run)
            run.clear()
            at //= FAN


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the steps of a path give."""
    for step in path.split(",") if path else ():
        at, siblings = int(step[0]) * _HEX, step[1:]
        leaf = hashlib.sha256((siblings[:at] + leaf + siblings[at:]).encode()).hexdigest()
    return leaf


def siblings(path: str) -> str:
    """All siblings of a path, from the leaf up and from left to right."""
    return "".join(step[1:] for step in path.split(",")) if path else ""


class Segment:
    """One builder's part of a log: digests by their places in the log of their tree."""

    def __init__(self, nodes: dict[int, str], n: int, level: int, span: int, above: str):
        """``above``: the path of the segment's own root; ``level``: its lowest."""
        self._nodes, self._n, self._height, self._above = nodes, n, height(n), above
        self._top = min(level + span, self._height)
        self._paths: dict[tuple[int, int], str] = {}

    def path(self, level: int, index: int) -> str:
        """The steps from a node to the root, as place in the run and siblings, joined by commas."""
        if level == self._top:
            return self._above
        known = self._paths.get((level, index))
        if known is None:
            run = index - index % FAN
            others = [self._nodes[position(level, j, self._n, self._height)]
                      for j in range(run, min(run + FAN, width(self._n, level))) if j != index]
            rest = self.path(level + 1, index // FAN)
            known = f"{index - run}{''.join(others)}" + ("," + rest if rest else "")
            self._paths[level, index] = known
        return known


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _block(row: dict) -> tuple[str, int]:
    return row["tree"], row["block"]


def _builder(tier: int, span: int):
    """Rows (tree, block, n, index, digest), each block's together and in order, to rows of the log."""
    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("tier", pa.int32()), ("block", pa.int64()), ("level", pa.int32()),
                        ("index", pa.int64()), ("position", pa.int64()), ("digest", pa.string())])

    def log(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, block), rows in groupby(_rows(batches), _block):
            run = list(rows)
            n, high = run[0]["n"], height(run[0]["n"])
            for level, index, digest in grow([r["digest"] for r in run], tier * span, run[0]["index"], n, min((tier + 1) * span, high)):
                yield tree, n, tier, block, level, index, position(level, index, n, high), digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(log(batches), schema)
    return run


def build(entries: DataFrame, span: int = SPAN) -> list[DataFrame]:
    """The logs of all trees, a table per tier of builders, from rows (tree, n, index, digest) of their leaves.

    ``index`` numbers a tree's n leaves from 0.  The number of tiers is that of the
    largest tree, the logarithm of its leaves to the base FAN**span.
    """
    most = entries.agg(F.max("n")).first()[0]
    logs: list[DataFrame] = []
    while most is not None and (not logs or height(most) > len(logs) * span):
        tier = len(logs)
        aligned = entries.select("tree", F.expr(f"index div {FAN ** span}").alias("block"), "n", "index", "digest") \
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        logs.append(staged(workers_ready(aligned).mapInArrow(_builder(tier, span), _LOG), f"merkle-log-{tier}"))
        above = (tier + 1) * span
        entries = logs[-1].filter((F.col("level") == above) & (F.col("n") > FAN ** above))
    return logs


def roots(logs: list[DataFrame]) -> DataFrame:
    """(tree, n, digest) of every tree's root: the last row of its log."""
    out = None
    for log in logs:
        tops = log.filter(F.col("index") == 0).groupBy("tree", "n").agg(F.max(F.struct("level", "digest")).alias("top"))
        out = tops if out is None else out.unionByName(tops)
    return out.groupBy("tree", "n").agg(F.max("top")["digest"].alias("digest"))


def _extractor(tier: int, span: int, leaves: bool):
    """Blocks of rows of kinds 0 (the path of the block's root), 1 (log) and 2 (leaves) to paths or to proofs of the leaves."""
    path_schema = pa.schema([("tree", pa.string()), ("index", pa.int64()), ("path", pa.string()), ("subroot", pa.string())])
    proof_schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof", pa.string()),
                              ("folded_root", pa.string())])

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, _), rows in groupby(_rows(batches), _block):
            own = next(rows)
            nodes: dict[int, str] = {}
            lowest: list[int] = []
            segment = None
            for row in rows:
                if row["kind"] == 1:
                    nodes[row["position"]] = row["digest"]
                    if row["level"] == tier * span:
                        lowest.append(row["index"])
                    segment = segment or Segment(nodes, row["n"], tier * span, span, own["path"])
                else:
                    path, leaf = segment.path(0, row["index"]), row["digest"]
                    yield (row["doc_id"], leaf, own["subroot"], hashlib.sha256(siblings(path).encode()).hexdigest(),
                           fold(row["tampered"] or leaf, path))
            for at in () if leaves else lowest:
                yield tree, at, segment.path(tier * span, at), own["subroot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(paths(batches), proof_schema if leaves else path_schema)
    return run


def extract(logs: list[DataFrame], above: DataFrame, leaves: DataFrame | None = None, span: int = SPAN) -> DataFrame:
    """Paths of all leaves, (tree, index, path, subroot); or of the rows ``leaves``, their proofs.

    ``above`` has each tree's (tree, path, subroot): the path of its root in a tree above it.  A
    builder's part of the log, the path of its root and its leaves meet in one task, at most
    FAN**span leaves; the paths come down tier by tier.
    """
    paths = above.select("tree", F.lit(0).cast("long").alias("index"), "path", "subroot")
    for tier in range(len(logs) - 1, -1, -1):
        last = leaves is not None and tier == 0
        rows = logs[tier].withColumn("kind", F.lit(1)).withColumn("at", F.col("position"))
        # of a tree that ends below this tier the root's path goes on to the next
        here = paths.join(logs[tier].groupBy("tree").agg(F.lit(True).alias("here")), "tree", "left")
        rows = rows.unionByName(here.filter("here").select("tree", F.col("index").alias("block"), "path", "subroot", F.lit(0).alias("kind")), True)
        if last:
            rows = rows.unionByName(leaves.select("tree", F.expr(f"index div {FAN ** span}").alias("block"), "index", F.col("index").alias("at"),
                                                  "doc_id", "digest", "tampered", F.lit(2).alias("kind")), True)
        else:
            rows = rows.withColumn("doc_id", F.lit(None).cast("long")).withColumn("tampered", F.lit(None).cast("string"))
        aligned = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "at")
        schema = "doc_id long, leaf string, subroot string, proof string, folded_root string" if last \
            else "tree string, index long, path string, subroot string"
        found = workers_ready(aligned).mapInArrow(_extractor(tier, span, last), schema)
        if last:
            return found
        paths = staged(found.unionByName(here.filter("here is null").drop("here")), f"merkle-paths-{tier}")
    return paths


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """The hash of a row, with ``text`` as its text: every field as byte count, colon and value, or ``-``."""
    return F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in _COLUMNS]), 256)


def number(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``index`` (from 0, by ``order`` within ``tree``) and ``n`` (the tree's rows), without a task that holds a whole tree.

    Range partitions are written once with running numbers; counts per tree and
    partition give the offsets.
    """
    parts = shuffle_partitions(leaves.sparkSession)
    ranged = staged(leaves.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
                    .withColumn("place", F.monotonically_increasing_id()), "merkle-order").withColumn("part", F.shiftright("place", 33))
    runs = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("own"), F.min("place").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("own").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", "first", before.alias("before"), F.sum("own").over(tree).alias("n"))
    return ranged.join(runs, ["tree", "part"]).withColumn("index", F.col("before") + F.col("place") - F.col("first")) \
        .drop("place", "part", "first", "before")


def manifest(docs: DataFrame, tampered: Column | None = None, span: int = SPAN) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``tampered`` is a text to fold from instead of the row's own, if not null.  ``proof_sha256``
    is the hash of all siblings from the leaf up, left to right; ``folded_root`` is what the
    tampered row and the original siblings give, and ``verified`` says whether it is ``root``.

    Defined cases: a null field counts as ``-``; rows of a null source are a tree before all
    others, and a null id comes first in its tree; of rows with one id, the one with the least
    hash comes first, and repeated rows are leaves of their own; an empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    # names of their own, whatever else the table holds; null sources sort before all
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf_hash(tampered))
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("tree"),
                       leaf_hash(F.col("text")).alias("digest"), other.alias("tampered"), F.monotonically_increasing_id().alias("serial"))
    leaves = number(staged(rows, "merkle-leaves"), ["doc_id", "digest", "serial"])
    logs = build(leaves, span)
    if not logs:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    sub = staged(roots(logs), "merkle-subroots")
    sources = number(sub.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), ["own"])
    top_logs = build(sources, span)
    root = roots(top_logs).first()["digest"]
    whole = spark.createDataFrame([("", "", root)], "tree string, path string, subroot string")
    ways = extract(top_logs, whole, span=span)
    above = sources.select("own", "index", "digest").join(ways.select("index", "path"), "index") \
        .select(F.col("own").alias("tree"), "path", F.col("digest").alias("subroot"))
    found = extract(logs, above, leaves, span)
    return found.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), F.col("proof").alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == root).alias("verified"))
