"""N-gram Jaccard join by vertical partitioning.

The n-grams have one global order (by hash), and the order is cut into fragments;
each document's set is cut into segments with it.

1. *Candidates*.  Sets that link are of like size, and at most d n-grams are in one
   of them only, so of more than d fragments some have the same segment in both.
   The segments of a set are ordered by how many sets have them, the rarest first;
   of two sets that link, the first d + 1 of each (its prefix) have one in common.
   Segments that one set alone has fill most prefixes: such sets have no candidates.
   A segment holds several n-grams, so it is rarely in sets that don't resemble each
   other, however many sets have its n-grams.  Sets that share a segment of their
   prefixes are joined to the first of them.
2. Candidate links are closed to groups (connected components).
3. *Partial overlaps*.  A group's sets meet in one task (a large group is dealt out
   in pairs of blocks), the overlaps of every fragment are counted separately and
   summed per pair, and the sums decide; only a spanning forest of the links and
   each set's number of links leave the task, never the pairs.
4. The links are closed to components.

No link is lost: steps 1 and 3 are exact.  Exact copies are one set throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.components import connected_components
from corpusflow.llm.textblocks import Words, blocks, gram_hashes, mix

#: Fragments, as a multiple of a prefix's segments.
POOL = 1.25
#: The least ratio of the bounds of a size class.
LIKE = 1.35
#: Segments of more sets than this are of one rank.
MOST_SETS = 1 << 16
BLOCK_SETS = 512
BLOCK_GRAMS = 1_000_000
#: A set's number, with the segments it can spare below it; a segment's hash, with its size class and whether it is empty below it.
_SET_BITS, _SPARE_BITS = 48, 15
_HASH_BITS, _CLASS_BITS = 40, 7
_NUMBER = (1 << _SET_BITS) - 1
_Q = np.uint64(0xD1342543DE82EF95)
_COLUMNS = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Threshold:
    """Link when ``den * intersection >= num * union``."""

    num: int = 90
    den: int = 100

    def differs(self, a: int) -> int:
        """The most n-grams by which a set of size a can differ from a linked set."""
        return (a + a * self.den // self.num) * (self.den - self.num) // (self.den + self.num)

    def classes(self, most: int) -> np.ndarray:
        """The least size in each size class, up to a class above ``most``; sets that link are in one class or in neighbours."""
        num, den, low = self.num, self.den, [1, 2]
        while self.num < self.den and den < LIKE * num:
            num, den = num * self.num, den * self.den
        while low[-2] <= most:
            low.append(max(low[-1] + 1, -(-low[-1] * den // num)))
        return np.array(low, np.int64)


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles (hashes) of each text of a block.

    Words are compared after lower-casing A-Z.  A text with fewer words has its
    whole sequence as its only shingle, one without words has none.
    """
    h = words.hashes(_LOWER[words.data])
    grams = gram_hashes(h, k)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1])
        elif b > a:
            yield gram_hashes(h[a:b], int(b - a)) ^ mix(np.array([b - a], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _signs(grams: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hi, lo = [], [], []
            for _, _, words in blocks(batch.column(1)):
                for grams in shingle_sets(words, k):
                    sign = _signs(grams)
                    n.append(len(grams))
                    hi.append(sign[0])
                    lo.append(sign[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (n, hi, lo))],
                                             ["doc_id", "n", "s1", "s2"])
    return run


def segments(sets: list[np.ndarray], limit: Threshold) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments of some sets as ``(segment, set, spare)``: in each size class of a set, how many come after its prefix.

    A set is in its own size class and, if it can link with a set of the next one, in that.
    Empty segments come last in the order of segments; a set has them only if it has too few others for a prefix.
    """
    size = np.array([len(s) for s in sets], np.int64)
    low = limit.classes(int(size.max()))
    own = np.searchsorted(low, size, side="right") - 1
    up = np.flatnonzero(size * limit.den >= low[own + 1] * limit.num)
    out = []
    for chosen, like in ((np.arange(len(sets)), own), (up, own[up] + 1)):
        if not len(chosen):
            continue
        prefix = np.array([limit.differs(int(low[c + 1]) - 1) + 1 for c in like], np.int64)
        parts = np.ceil(prefix * POOL).astype(np.uint64)
        grams = np.concatenate([sets[i] for i in chosen])
        of = np.repeat(np.arange(len(chosen)), size[chosen])
        part = (grams >> np.uint64(32)) * parts[of] >> np.uint64(32)
        at = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (of[1:] != of[:-1])])
        of, part, total = of[at], part[at], np.add.reduceat(grams, at)
        have = np.bincount(of, minlength=len(chosen))
        empty = np.zeros(len(of), np.int64)
        for i in np.flatnonzero(have < prefix):
            none = np.setdiff1d(np.arange(parts[i], dtype=np.uint64), part[of == i])
            of, part = np.r_[of, np.full(len(none), i)], np.r_[part, none]
            total, empty = np.r_[total, np.zeros(len(none), np.uint64)], np.r_[empty, np.ones(len(none), np.int64)]
        spare = np.maximum(np.bincount(of, minlength=len(chosen)) - prefix, 0)
        with np.errstate(over="ignore"):
            key = mix(total + mix(part * _Q + like[of].astype(np.uint64) + np.uint64(1)))
        key = (key >> np.uint64(64 - _HASH_BITS)).astype(np.int64) << _CLASS_BITS | like[of]
        out.append((key << 1 | empty, chosen[of], spare[of]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _segments(k: int, limit: Threshold):
    """``(segment, set)``, the set as its number and spare segments; of the equal sets of a task one speaks for all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for _, _, words in blocks(batch.column(0)):
                sets, number = [], []
                for grams in shingle_sets(words, k):
                    if not limit.differs(len(grams)):  # only an equal set can link
                        continue
                    sign = _signs(grams)
                    if sign.tobytes() not in seen:
                        seen.add(sign.tobytes())
                        sets.append(grams)
                        number.append(int(sign[0]) & _NUMBER)
                if sets:
                    segment, of, spare = segments(sets, limit)
                    spare = np.minimum(spare, (1 << _SPARE_BITS) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(segment), pa.array(np.array(number, np.int64)[of] << _SPARE_BITS | spare)], ["segment", "set"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (segment, set): those of segments in several sets, with the number of sets, MOST_SETS at most."""
    segment, own = np.zeros(0, np.int64), np.zeros(0, np.int64)
    last, hot = None, None  # the row before these; the segment whose first MOST_SETS rows have gone already

    def counted(segment: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(segment) else np.zeros(0, np.int64)
        n = np.diff(np.r_[at, len(segment)])
        sets = np.repeat(np.where(segment[at] == hot, MOST_SETS, np.minimum(n, MOST_SETS)), n) if len(at) else at
        some = sets > 1
        return pa.RecordBatch.from_arrays([pa.array(segment[some]), pa.array(own[some]), pa.array(sets[some].astype(np.int64))],
                                          ["segment", "set", "sets"])

    for batch in batches:
        if not batch.num_rows:
            continue
        more, other = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.r_[last != (more[0], other[0]), (more[1:] != more[:-1]) | (other[1:] != other[:-1])]  # equal sets of other tasks
        last = more[-1], other[-1]
        segment, own = np.r_[segment, more[new]], np.r_[own, other[new]]
        if not len(segment):
            continue
        upto = int(np.searchsorted(segment, segment[-1]))  # the last segment may go on
        if segment[-1] == hot or len(segment) - upto >= MOST_SETS:
            upto = len(segment)
        yield counted(segment[:upto], own[:upto])
        if upto == len(segment):
            hot = segment[-1]
        segment, own = segment[upto:], own[upto:]
    yield counted(segment, own)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (set, size class), the last in the order of segments first: those after a set's spare ones, without them."""
    last, gone = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        segment, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        like = segment >> 1 & (1 << _CLASS_BITS) - 1
        new = np.r_[last != (own[0], like[0]), (own[1:] != own[:-1]) | (like[1:] != like[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(own)), -1))
        place = np.arange(len(own)) - start
        place[start < 0] += gone - 1
        last, gone = (own[-1], like[-1]), int(place[-1]) + 1
        kept = place >= own & (1 << _SPARE_BITS) - 1
        yield pa.RecordBatch.from_arrays([pa.array(segment[kept]), pa.array(own[kept] >> _SPARE_BITS)], ["key", "number"])


def _prefix_keys(docs: DataFrame, k: int, limit: Threshold) -> DataFrame:
    """``(key, number)``: a key per segment of a set's prefix that other sets have too."""
    shared = docs.select("text").mapInArrow(_segments(k, limit), "segment long, set long") \
        .repartition("segment").sortWithinPartitions("segment", "set") \
        .mapInArrow(_shared, "segment long, set long, sets long")
    like, empty = F.shiftright("segment", 1).bitwiseAND((1 << _CLASS_BITS) - 1), F.col("segment").bitwiseAND(1)
    return shared.repartition("set").sortWithinPartitions("set", like, empty.desc(), F.desc("sets"), F.desc("segment")) \
        .mapInArrow(_prefixes, "key long, number long")


def _first_of_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, number): links from each key's first set to the others."""
    last_key = last_hub = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        hub = own[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        if last_key is not None and key[0] == last_key:
            upto = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(key)
            hub[:upto] = last_hub
        last_key, last_hub = key[-1], hub[-1]
        pairs = np.unique(np.stack([hub, own], 1)[hub != own], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


def _with_grams(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["comp", "i", "j", "block", "doc_id", "copies", "grams"]
        for batch in batches:
            comp, block, nblocks, copies = (batch.column(c).to_pylist() for c in (2, 3, 4, 5))
            ids = batch.column(0).to_pylist()
            for lo, _, words in blocks(batch.column(1)):
                rows: list[tuple] = []
                for at, grams in enumerate(shingle_sets(words, k), lo):
                    raw = grams.tobytes()
                    for other in range(nblocks[at]):
                        i, j = sorted((block[at], other))
                        rows.append((comp[at], i, j, block[at], ids[at], copies[at], raw))
                    if sum(len(r[-1]) for r in rows[-nblocks[at]:]) > 1 << 22 or len(rows) > 4000:
                        yield pa.RecordBatch.from_arrays(_columns(rows), names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(_columns(rows), names)
    return run


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]


def overlaps(sets: list[np.ndarray], cut: int | None = None) -> np.ndarray:
    """Matrix of intersection sizes: partial overlaps of the fragments of the global order, summed.

    With ``cut``, of the sets before it with those from it on.
    """
    k = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column, minlength=1)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.unique(column, return_inverse=True)[1]
    rows, columns = slice(0, cut), slice(cut or 0, k)
    out = np.zeros((len(sets[rows]), len(sets[columns])), np.int64)
    for lo in range(0, int(column.max()) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + _COLUMNS])
        part = np.zeros((k, min(_COLUMNS, int(column[b - 1]) - lo + 1)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        out += np.rint(part[rows] @ part[columns].T).astype(np.int64)
    return out


def _verify(limit: Threshold):
    def decide(group: list[tuple], across: bool) -> list[tuple]:
        group = sorted(group, key=lambda g: g[0])
        ids = [g[1] for g in group]
        copies = np.array([g[2] for g in group])
        sets = [np.frombuffer(g[3], np.uint64) for g in group]
        size = np.array([len(s) for s in sets])
        cut = next((i for i, g in enumerate(group) if g[0] != group[0][0]), None) if across else 0
        if cut is None:
            return []
        same = overlaps(sets, cut or None)
        near = limit.den * same >= limit.num * (size[:cut or None, None] + size[None, cut:] - same)
        if across:
            linked = np.zeros((len(group), len(group)), bool)
            linked[:cut, cut:] = near
            linked[cut:, :cut] = near.T
        else:
            linked = near
            np.fill_diagonal(linked, False)
        out = [(ids[i], None, int(d)) for i, d in enumerate(linked @ copies) if d]
        left = np.ones(len(group), bool)
        for i in range(len(group)):
            edge = np.flatnonzero(left[i:i + 1]) + i
            while len(edge):
                left[edge] = False
                edge = np.flatnonzero(linked[edge].any(0) & left)
                out += [(ids[i], ids[j], 0) for j in edge]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def done() -> pa.RecordBatch:
            rows = decide(group, at[1] != at[2]) if len(group) > 1 else []
            u, v, d = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()),
                                               pa.array(d, pa.int64())], ["u", "v", "links"])
        for batch in batches:
            comp, i, j, block, doc, copies, grams = (c.to_pylist() for c in batch.columns)
            for row in zip(comp, i, j, block, doc, copies, grams, strict=True):
                if row[:3] != at:
                    if group:
                        yield done()
                    at, group = row[:3], []
                group.append(row[3:])
        if group:
            yield done()
    return run


def jaccard_join(docs: DataFrame, k: int = 5, limit: Threshold = Threshold(80, 100),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, n_links``.

    Two documents link when the Jaccard similarity of their sets of distinct
    k-word shingles (A-Z lower-cased; words are runs of non-white-space) reaches
    ``limit``; ``component_id`` is the least id reachable by links, itself
    included, ``n_links`` the number of documents linked to it.

    Defined cases: null and empty texts have size 0, link with nothing and are
    their own component; a text of fewer than k words has one shingle; equal
    texts link; rows without an id get a null component and take no part; rows
    that repeat an id are documents of that id; an empty table gives no rows;
    other columns are ignored.
    """
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = staged(docs.mapInArrow(_sets(k), "doc_id long, n long, s1 long, s2 long"), "join-sets")
    known = sets.filter("n > 0 and doc_id is not null")
    same = known.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    member = staged(known.join(same, ["s1", "s2"])
                    .select("doc_id", "rep", "copies", F.col("s1").bitwiseAND(_NUMBER).alias("number")), "join-members")

    keys = _prefix_keys(docs.filter("doc_id is not null"), k, limit)
    near = keys.repartition("key").sortWithinPartitions("key", "number").mapInArrow(_first_of_run, "u long, v long").distinct()
    reps = member.select("number", "rep").distinct()
    near = near.join(reps.toDF("u", "ru"), "u").join(reps.toDF("v", "rv"), "v") \
        .select(F.col("ru").alias("u"), F.col("rv").alias("v"))
    group = connected_components(near, "join-candidates").toDF("rep", "comp")

    group = staged(group.join(member.filter("doc_id = rep").select("doc_id", "rep", "copies").distinct(), "rep")
                   .join(known.select("doc_id", "n").distinct(), "doc_id")
                   .select("rep", "comp", "copies", "n"), "join-groups")
    size = group.groupBy("comp").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("nblocks"))
    dealt = group.join(size, "comp").select(
        F.col("rep").alias("doc_id"), "comp",
        F.pmod(F.xxhash64("rep"), F.col("nblocks")).cast("int").alias("block"), "nblocks", "copies")
    # one plan at every size: the members grow with the corpus, so they are not broadcast even while they are few
    grams = docs.join(dealt.hint("merge"), "doc_id").select("doc_id", "text", "comp", "block", "nblocks", "copies") \
        .mapInArrow(_with_grams(k), "comp long, i int, j int, block int, doc_id long, copies long, grams binary")
    found = staged(grams.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
                   .mapInArrow(_verify(limit), "u long, v long, links long"), "join-links")

    component = connected_components(found.filter("v is not null"), "join-components").toDF("rep", "component")
    links = found.filter("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    final = member.join(component, "rep", "left").join(links, "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component"),
        F.max(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return sets.join(final, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents with the least id of their component; all columns stay.

    Rows without an id and texts without words always stay.
    """
    found = jaccard_join(docs.select("doc_id", "text"), **options)
    extra = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(extra.hint("merge"), "doc_id", "left_anti")  # it grows with the corpus
