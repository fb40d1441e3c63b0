"""Substring deduplication with repeated-phrase automata.

A window is ``width`` consecutive words of one document.  A word goes when some
window over it also starts earlier (a smaller doc_id, or earlier in the same
document).  Windows are judged on the input.

1. *Anchors.*  Among the ``gram``-word grams inside a window, the one with the least
   hash (the leftmost of equals) is its anchor.  Equal windows have equal
   anchors, so only occurrences of one anchor need to meet.  Neighbouring
   windows mostly share an anchor: one row per anchor place stands for them
   (about one row per eight words), with a hash of the span that they cover.
2. *Choosing.*  Rows sorted by (anchor, span): rows after the first of a span are
   equal to it in whole, by the hash of the span, and need no automaton.  The first rows
   of anchors with several spans may share some windows; their words go on to step 3.
3. *Automata.*  Those spans are dealt out in slices of about SLICE_BYTES, whatever their
   anchors.  Each slice gives its windows with their least places; these are summed per
   window, and the windows of several places go back to the slices that have them.
   There they are compiled to an Aho-Corasick automaton, through which the slice's
   spans are streamed; every occurrence after the first is a repeat.  No task needs all
   spans of an anchor or all places of a window.
4. The repeated ranges meet their documents, and the other words stay.

Documents without a repeated anchor cannot hold a repeated window, so leaving
them out of step 3 loses nothing.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.textblocks import Prefix, Words, blocks, gram_hashes, mix, row_of

#: Bytes of the spans that one automaton is made for and streamed with.
SLICE_BYTES = 1 << 20
_STEP = 1 << 19
_LOW = np.uint64((1 << 20) - 1)


def _owned(words: Words, width: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per anchor place: text number, hash of the anchor, first window (word of the text), windows - 1, hash of the span."""
    h = words.hashes()
    if len(h) < width:
        return
    text = row_of(words.first)
    per = width - gram + 1
    for lo in range(0, len(h) - width + 1, _STEP):
        part = h[lo:lo + _STEP + width - 1]
        grams = gram_hashes(part, gram)
        least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= per:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < per:
            least = np.minimum(least[:-(per - span)], least[per - span:])
        at = (least & _LOW).astype(np.int64)
        start = np.arange(len(at))
        inside = text[lo + start] == text[lo + start + width - 1]
        new = inside.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
        begin = np.flatnonzero(new)
        if not len(begin):
            continue
        last = np.ones(len(at), bool)
        last[:-1] = new[1:] | ~inside[1:]
        end = np.flatnonzero(last & inside)
        spans = Prefix(part).of(begin, end + width) ^ mix((at[begin] - begin).astype(np.uint64))
        doc = text[lo + begin]
        yield doc, grams[at[begin]], lo + begin - words.first[doc], end - begin, spans


def _anchors(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, words in blocks(batch.column(1)):
                for doc, key, first, more, span in _owned(words, width, gram):
                    doc_id = ids[lo + doc]
                    # all but the first of equal spans of a block are repeats; those rows need not meet others
                    order = np.lexsort((first, doc_id, span, key))
                    known = np.zeros(len(order), bool)
                    known[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (span[order[1:]] == span[order[:-1]])
                    # an equal place (a repeated row) is not a later one
                    twin = (doc_id[order[1:]] == doc_id[order[:-1]]) & (first[order[1:]] == first[order[:-1]])
                    known[order[1:][twin]] = False
                    key = np.where(known, mix(key + first.astype(np.uint64) + mix(doc_id.astype(np.uint64))), key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(known), pa.array(key.view(np.int64)), pa.array(span.view(np.int64)), pa.array(doc_id),
                         pa.array(first.astype(np.int32)), pa.array(more.astype(np.int32))],
                        ["known", "key", "span", "doc_id", "first", "more"])
    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (known, key, span, doc_id, first): repeats in whole, and spans to look into.

    Only the last row and one undecided row are kept between batches.
    """
    names = ["whole", "key", "doc_id", "first", "more"]
    last = None  # key, span, doc_id and first of the first row of the last span
    open_row: tuple | None = None  # first span of the last key, until a second one comes
    for batch in batches:
        if not batch.num_rows:
            continue
        known, key, span, doc, first, more = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        whole = known.copy()
        new_key, new_span = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_span[1:] = new_key[1:] | (span[1:] != span[:-1])
        if last is not None:
            new_key[0] = key[0] != last[0]
            new_span[0] = new_key[0] or span[0] != last[1]
        new_key |= known
        new_span |= known
        lead = np.maximum.accumulate(np.where(new_span, np.arange(len(key)), -1))
        lead_doc, lead_first = doc[lead], first[lead]
        if last is not None:
            lead_doc, lead_first = np.where(lead < 0, last[2], lead_doc), np.where(lead < 0, last[3], lead_first)
        whole |= ~new_span & ((doc != lead_doc) | (first != lead_first))
        heads = np.flatnonzero(new_span & ~known)
        inner = np.zeros(len(key), bool)
        inner[heads] = ~new_key[heads]
        if len(heads) > 1:
            inner[heads[:-1]] |= ~new_key[heads[1:]]
        if len(heads):
            if open_row is not None and not new_key[heads[0]]:
                yield pa.RecordBatch.from_arrays([pa.array([x]).cast(t) for x, t in zip(
                    (False, *open_row), (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names)
            h = heads[-1]
            open_row = (int(key[h]), int(doc[h]), int(first[h]), int(more[h])) if new_key[h] else None
        if not known[-1]:
            last = int(key[-1]), int(span[-1]), int(lead_doc[-1]), int(lead_first[-1])
        out = whole | inner
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (whole, key, doc, first, more)], names)


def _spans(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, todo = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, _, words in blocks(batch.column(1)):
                rows: list[tuple] = []
                data = words.data.tobytes()
                for i, a in enumerate(words.first[:-1]):
                    for first, more in ((x["first"], x["more"]) for x in todo[lo + i]):
                        b, e = a + first, a + first + more + width - 1
                        if e >= words.first[i + 1]:
                            continue  # another row of this id
                        rows.append((ids[lo + i], first, b" ".join(data[words.start[b]:words.end[e]].split()).decode()))
                for at in range(0, len(rows), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                        zip(*rows[at:at + 20_000], strict=True), (pa.int64(), pa.int32(), pa.string()), strict=True)], ["doc_id", "first", "words"])
    return run


def _digest(window: str) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(window.encode(), digest_size=16).digest())


def locate(rows: list[tuple[int, int, int, int, str]], width: int,
           known: dict[tuple[int, int], tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """Ranges (doc_id, first word, words) of the windows that also start earlier among ``rows``.

    ``rows``: (part, parts, doc_id, first word, words joined by a space), all
    spans of some windows.  The windows that occur at several places are compiled
    to one automaton, and all rows are streamed through it.  ``known``: digests and
    first places of those windows, if the rows are only a slice of the spans.
    """
    import ahocorasick

    places: dict[str, tuple[int, int]] = {}
    again: set[str] = set()
    for _, _, doc, first, line in rows:
        own = line.split(" ")
        for j in range(len(own) - width + 1):
            window = " ".join(own[j:j + width])
            if known is not None:
                if window not in places and (place := known.get(_digest(window))):
                    again.add(window)
                    places[window] = place
                continue
            at = (doc, first + j)
            old = places.setdefault(window, at)
            if old != at:
                again.add(window)
                if at < old:
                    places[window] = at
    if not again:
        return []
    automaton = ahocorasick.Automaton()
    for window in again:
        automaton.add_word(f" {window} ", (len(window) + 1, *places[window]))
    automaton.make_automaton()
    out = []
    for _, _, doc, first, line in rows:
        at = lo = hi = 0  # words before the character `at`; the open range
        seen, text = 0, f" {line} "
        for end, (size, *place) in automaton.iter(text):
            begin = end - size + 1  # the first character of the window's first word
            seen += text.count(" ", at, begin)
            at = begin
            j = seen - 1
            if (doc, first + j) <= tuple(place):
                continue
            if hi and j <= hi:
                hi = j + width
            else:
                if hi:
                    out.append((doc, first + lo, hi - lo))
                lo, hi = j, j + width
        if hi:
            out.append((doc, first + lo, hi - lo))
    return out


def _ranges(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    doc, first, size = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(first, pa.int32()),
                                       pa.array(size, pa.int32())], ["doc_id", "first", "size"])


def _places(width: int):
    """Rows (part, doc_id, first, words) to their windows: digest, least place and whether there are several, per part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "a", "b", "doc_id", "first", "several"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        for batch in batches:
            ends: dict[tuple, tuple] = {}
            for part, doc, first, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = line.split(" ")
                for j in range(len(own) - width + 1):
                    window, at = (part, " ".join(own[j:j + width])), (doc, first + j)
                    lo, hi = ends.get(window, (at, at))
                    ends[window] = min(lo, at), max(hi, at)
            out = [(part, *_digest(w), *lo, lo != hi) for (part, w), (lo, hi) in ends.items()]
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                    zip(*out[at:at + 20_000], strict=True), kinds, strict=True)], names)
    return run


def _slices(width: int):
    """Rows sorted by part: a slice's spans, and its repeated windows (without words) with their first places."""
    def located(rows: list[tuple]) -> pa.RecordBatch:
        known = {(a, b): (doc, first) for _, doc, first, line, a, b in rows if line is None}
        return _ranges(locate([(0, 1, doc, first, line) for _, doc, first, line, _, _ in rows if line is not None], width, known) if known else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and row[0] != rows[0][0]:
                    yield located(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield located(rows)
    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept"]
    for batch in batches:
        todo = batch.column(2)
        for lo, hi, words in blocks(batch.column(1)):
            own = todo.slice(lo, hi - lo)
            flat, at = pc.list_flatten(own), pc.list_parent_indices(own).to_numpy()
            change = np.zeros(len(words) + 1, np.int64)
            start = words.first[at] + flat.field("first").to_numpy(zero_copy_only=False)
            end = np.minimum(start + flat.field("size").to_numpy(zero_copy_only=False), words.first[at + 1])
            start = np.minimum(start, end)
            np.add.at(change, start, 1)
            np.add.at(change, end, -1)
            kept = np.cumsum(change)[:-1] == 0
            n = np.diff(words.first)
            before = np.concatenate([[0], np.cumsum(kept)])
            n_kept = before[words.first[1:]] - before[words.first[:-1]]
            text, at = _joined(words, kept, n_kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(n - n_kept),
                 pa.array([text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names)


def _joined(words: Words, kept: np.ndarray, n_kept: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Each text's kept words joined by one space: all bytes, and where each text begins."""
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[words.start[kept]] += 1
    edge[words.end[kept]] -= 1
    take = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    of_kept = np.flatnonzero(kept)
    followed = np.ones(len(of_kept), bool)
    followed[np.cumsum(n_kept)[n_kept > 0] - 1] = False
    gap = words.end[of_kept[followed]]
    data = words.data.copy()
    data[gap] = 0x20
    take[gap] = True
    size = np.concatenate([[0], np.cumsum(take)])
    return data[take].tobytes(), size[words.text_at]


def _located(spans: DataFrame, width: int) -> DataFrame:
    """``(doc_id, first, size)`` of the repeats inside spans ``(doc_id, first, words)``."""
    size = spans.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    parts = int(size // SLICE_BYTES) + 1
    spans = spans.select(F.pmod(F.xxhash64("doc_id", "first"), F.lit(parts)).alias("part"), "doc_id", "first", "words")
    places = spans.mapInArrow(_places(width), "part long, a long, b long, doc_id long, first int, several boolean")
    place = F.struct("doc_id", "first")
    again = staged(places.groupBy("a", "b").agg(F.min(place).alias("place"), (F.max("several") | (F.min(place) != F.max(place))).alias("several"))
                   .filter("several").select("a", "b", "place.doc_id", "place.first"), "phrase-windows")
    back = places.select("part", "a", "b").join(again, ["a", "b"]).select("part", "doc_id", "first", F.lit(None).cast("string").alias("words"), "a", "b")
    none = F.lit(None).cast("long")
    rows = spans.select("*", none.alias("a"), none.alias("b")).unionByName(back)
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_slices(width), "doc_id long, first int, size int")


def repeated_ranges(docs: DataFrame, width: int = 20, gram: int = 4) -> DataFrame:
    """``(doc_id, first, size)``: runs of words under windows that also start earlier (runs may overlap)."""
    rows = docs.filter("doc_id is not null").mapInArrow(
        _anchors(width, gram), "known boolean, key long, span long, doc_id long, first int, more int")
    seen = staged(rows.repartition("key").sortWithinPartitions("known", "key", "span", "doc_id", "first")
                  .mapInArrow(_confirm, "whole boolean, key long, doc_id long, first int, more int"), "phrase-anchors")
    todo = seen.filter("not whole").groupBy("doc_id").agg(F.collect_list(F.struct("first", "more")).alias("todo"))
    spans = staged(docs.join(todo, "doc_id").select("doc_id", "text", "todo").mapInArrow(
        _spans(width), "doc_id long, first int, words string"), "phrase-spans")
    return seen.filter("whole").select("doc_id", "first", (F.col("more") + width).alias("size")).unionAll(_located(spans, width))


def substring_dedup(docs: DataFrame, width: int = 20, gram: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (UTF-8 bytes of the kept words, joined by a space).

    Defined cases: a null or empty text has no words; a text of fewer than
    ``width`` words loses none; rows without an id keep all their words and take
    no part; rows that repeat an id and a text are one document (neither is
    earlier); an empty table gives no rows; other columns are ignored.
    """
    if not 1 <= gram <= width:
        raise ValueError("gram must be between 1 and width")
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranges = repeated_ranges(docs, width, gram).groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "size")).alias("ranges"))
    return docs.join(ranges, "doc_id", "left").select("doc_id", "text", "ranges").mapInArrow(
        _keep, "doc_id long, n_words long, n_removed long, kept binary")


def sha256_hex(data: bytes) -> str:
    """Lower-case hex digest, for tests."""
    return hashlib.sha256(data).hexdigest()
