"""Best-fit packing of tokenized documents, improved by swap-based local search.

1. *Tokens*: every distinct word is encoded once per worker (see WordIds), and each
   document's ids are put together from its words'.  A document is its ids and
   one end id; longer ones are cut into pieces of ``size`` ids.
2. *Packing*: pieces are dealt by a hash of document and piece into groups of about
   ``GROUP`` pieces.  A group is packed by best fit, longest first; then pieces of
   the least filled sequences are moved to others, exchanged one for one, two
   for one or one for two, always so that the sum of squared fills grows, until
   sequences run empty.
3. The pieces of sequences that still have room (a few per group) are dealt into new
   groups and packed again, so what is lost does not grow with the number of groups.

A group's size is fixed, so no task grows with the corpus, and the hash keeps hot
sources apart.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.textblocks import Words, blocks

GROUP = 40_000
#: Sequences filled below this share are packed again in the second round.
LOOSE = 0.99
#: Words that a worker remembers; beyond, it starts anew.
REMEMBERED = 4_000_000
_LEAST_FILLED = 8
_PAIR_REACH = 8
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Ids of words, remembered by the words' hashes in sorted arrays."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self._encode = encode
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._n = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)
        self._used = 0

    def ids(self, hashes: np.ndarray, word: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids in a row, and how many each word has; ``word(i)`` gives the i-th word's text."""
        unique, example, each = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._keys) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self._keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self._keys)
        known[inside] = self._keys[at[inside]] == unique[inside]
        if not known.all():
            new = self._encode([word(int(i)) for i in example[~known]])
            n = np.fromiter(map(len, new), np.int64, len(new))
            flat = np.fromiter((x for ids in new for x in ids), np.uint32, int(n.sum()))
            if self._used + len(flat) > len(self._pool):
                self._pool = np.concatenate([self._pool[:self._used], np.zeros(2 * (self._used + len(flat)), np.uint32)])
            self._pool[self._used:self._used + len(flat)] = flat
            begin = self._used + np.cumsum(n) - n
            self._used += len(flat)
            self._keys = np.insert(self._keys, at[~known], unique[~known])
            self._at = np.insert(self._at, at[~known], begin)
            self._n = np.insert(self._n, at[~known], n)
            at = np.searchsorted(self._keys, unique)
        begin, n = self._at[at][each], self._n[at][each]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return self._pool[np.repeat(begin, n) + place], n


_ENCODERS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        _ENCODERS[path] = WordIds(lambda words: [e.ids for e in model.encode_batch(words, add_special_tokens=False)])
    return _ENCODERS[path]


def block_ids(words: Words, known: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """The texts' ids in a row, and where each text's begin (n + 1 places).

    The tokenizer drops white space, lower-cases, and never joins a letter to a
    following full stop or comma, so texts may be cut at white space and there;
    words of ASCII alone may be lower-cased first.  (Its special tokens hold '<|':
    blocks with that are left as they are.)
    """
    data = words.data
    if not len(words):
        return np.zeros(0, np.uint32), np.zeros(len(words.first), np.int64)
    first = words.first
    if b"<|" not in data.tobytes():
        wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
        plain = wide[words.end] == wide[words.start]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[words.start[plain]] += 1
        edge[words.end[plain]] -= 1
        lower = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        data = np.where(lower, _ASCII_LOWER[data], data)
        last = words.end - 1
        cut = ((data[last] == 0x2E) | (data[last] == 0x2C)) & (last > words.start)
        cut &= _IS_LETTER[data[np.maximum(last - 1, 0)]]
        split = Words.__new__(Words)
        split.data = data
        split.start = np.insert(words.start, np.flatnonzero(cut) + 1, last[cut])
        end = np.where(cut, last, words.end)
        split.end = np.insert(end, np.flatnonzero(cut) + 1, words.end[cut])
        split.first = first + np.concatenate([[0], np.cumsum(cut)])[first]
        words, first = split, split.first
    raw = data.tobytes()
    ids, n = known.ids(words.hashes(), lambda i: raw[words.start[i]:words.end[i]].decode())
    return ids, np.concatenate([[0], np.cumsum(n)])[first]


def _pieces(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, _, words in blocks(batch.column(1)):
                ids, at = block_ids(words, known)
                ids = ids.astype("<u4", copy=False)
                rows: list[tuple] = []
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    total = b - a + 1
                    for piece, start in enumerate(range(0, total, size)):
                        stop = min(start + size, total)
                        raw = ids[a + start:min(a + stop, b)].tobytes() + (end if stop == total else b"")
                        rows.append((names[lo + i], piece, start, stop - start, zlib.crc32(raw)) + ((raw,) if with_ids else ()))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                for part in range(0, len(rows), 20_000):
                    columns = zip(*rows[part:part + 20_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=False)],
                        ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])
    return run


def _best_fit(length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence of each piece and fill of each sequence, by best fit, longest first."""
    order = np.argsort(-length, kind="stable")
    place = np.empty(len(length), np.int64)
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some sequence has room r
    fill: list[int] = []
    for i, need in zip(order.tolist(), length[order].tolist(), strict=True):
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            fill[at] += need
        else:
            at, room = len(fill), size
            fill.append(need)
        left = room - need
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
        place[i] = at
    return place, np.array(fill, np.int64)


def local_search(length: np.ndarray, place: np.ndarray, fill: np.ndarray, size: int) -> int:
    """Improve a packing in place; returns the number of steps.

    Every step takes one or two pieces of a little filled sequence A to a sequence
    B that is filled at least as much, for none, one or two pieces of B, so that B
    fits and gains: the sum of squared fills grows, and A empties in the end.
    """
    least = -(-int(length.sum()) // size)
    steps = 0

    def move(pieces: list[int], b: int, back: list[int], a: int) -> None:
        gain = int(length[pieces].sum() - length[back].sum())
        place[pieces], place[back] = b, a
        fill[b] += gain
        fill[a] -= gain

    def step(a: int) -> bool:
        room = size - fill
        other = (fill > 0) & (room > 0) & (fill >= fill[a])
        other[a] = False
        if not other.any():
            return False
        widest = int(room[other].max())
        own = np.flatnonzero(place == a)
        own = own[np.argsort(-length[own], kind="stable")]
        for i in own.tolist():  # move
            fits = np.flatnonzero(other & (room >= length[i]))
            if len(fits):
                move([i], int(fits[np.argmin(room[fits])]), [], a)
                return True
        candidates = np.flatnonzero(other[place])
        if not len(candidates):
            return False
        c_length, c_room = length[candidates], room[place[candidates]]
        sums = [([i], int(length[i])) for i in own.tolist()]
        few = own[:64].tolist()
        sums += [([i, j], int(length[i] + length[j])) for n, i in enumerate(few) for j in few[n + 1:]]
        for pieces, total in sums:  # one for one, two for one
            gain = total - c_length
            good = (gain > 0) & (gain <= c_room)
            if good.any():
                best = int(np.argmax(np.where(good, gain, -1)))
                move(pieces, int(place[candidates[best]]), [int(candidates[best])], a)
                return True
        by_place = candidates[np.lexsort((length[candidates], place[candidates]))]
        for reach in range(1, _PAIR_REACH + 1):  # one for two
            x, y = by_place[:-reach], by_place[reach:]
            same = place[x] == place[y]
            x, y = x[same], y[same]
            if not len(x):
                break
            both, p_room = length[x] + length[y], room[place[x]]
            for i in own.tolist():
                gain = int(length[i]) - both
                good = (gain > 0) & (gain <= np.minimum(p_room, widest))
                if good.any():
                    best = int(np.argmax(np.where(good, gain, -1)))
                    move([i], int(place[x[best]]), [int(x[best]), int(y[best])], a)
                    return True
        return False

    while int((fill > 0).sum()) > least:
        live = np.flatnonzero(fill > 0)
        for a in live[np.argsort(fill[live], kind="stable")][:_LEAST_FILLED].tolist():
            if step(a):
                steps += 1
                break
        else:
            break
    return steps


def pack_lengths(length: np.ndarray, size: int) -> np.ndarray:
    """The sequence number of each piece."""
    place, fill = _best_fit(length, size)
    local_search(length, place, fill, size)
    return place


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: pa.Table, group: int) -> Iterator[pa.RecordBatch]:
            length = rows.column("length").to_numpy()
            place = pack_lengths(length, size)
            order = np.argsort(place, kind="stable")
            ordered = length[order]
            before = np.cumsum(ordered) - ordered
            head = np.ones(len(order), bool)
            head[1:] = place[order][1:] != place[order][:-1]
            offset = np.empty(len(order), np.int64)
            offset[order] = before - np.maximum.accumulate(np.where(head, before, 0))
            fill = np.bincount(place, weights=length).astype(np.int64)[place]
            out = rows.append_column("bin", pa.array(place)).append_column("fill", pa.array(fill)) \
                .append_column("offset", pa.array(offset))
            yield from out.to_batches(20_000)

        held: list[pa.RecordBatch] = []
        group = None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column("group").to_numpy()
            for a, b in _runs(of):
                if held and of[a] != group:
                    yield from done(pa.Table.from_batches(held), group)
                    held = []
                group = of[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from done(pa.Table.from_batches(held), group)
    return run


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)


def _round(pieces: DataFrame, columns: str, size: int) -> DataFrame:
    groups = max(1, -(-pieces.count() // GROUP))
    # by the row's number in the written table, so that rows of equal or no ids are dealt out as well
    return pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))) \
        .repartition("group").sortWithinPartitions("group", "doc_id", "piece") \
        .mapInArrow(_packed(size), f"{columns}, group long, bin long, fill long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 1, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers.  Sequences hold at most
    ``size`` ids, without gaps.

    Defined cases: a null or empty text is the end id alone; a text of more than
    ``size`` - 1 ids is cut, and only such a text; rows with a null id and
    repeated rows are packed like any others; an empty table gives no rows; other
    columns are ignored.  ``tokenizer_path`` must be readable on every executor.
    """
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    columns = PIECES + ", ids binary" * with_ids
    names = [c.split()[0] for c in columns.split(", ")]
    pieces = staged(docs.mapInArrow(_pieces(tokenizer_path, size, end_id, with_ids), columns), "pack-pieces")
    first = staged(_round(pieces, columns, size), "pack-first")
    loose = first.filter(F.col("fill") < int(LOOSE * size)).select(*names)
    second = _round(loose, columns, size)
    return first.filter(F.col("fill") >= int(LOOSE * size)) \
        .withColumn("sequence_id", F.col("group") * GROUP * 2 + F.col("bin")) \
        .unionByName(second.withColumn("sequence_id", -(F.col("group") * GROUP * 2 + F.col("bin")) - 1)) \
        .select(*names[:5], "sequence_id", "offset", *names[5:])
