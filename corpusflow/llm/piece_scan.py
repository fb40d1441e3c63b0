"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

The vocabulary is read as a unigram lattice: a segmentation's score is the sum of its
pieces' scores, and the best one is wanted.  (A vocabulary of merges keeps its
scores, the negative ranks; its best segmentation is not the one that merging
gives.)  The text is prepared as the model says: a space in front, spaces written
as U+2581; a character without a piece costs UNKNOWN more than the worst piece and
becomes its bytes' pieces.

No piece holds a space mark after another character, so the places before such marks
are always cut, as those around white space that is in no piece, and a word with the
marks before it has the same best segmentation everywhere: ordinary documents are
put together from remembered words.

A giant document is cut into chunks, whatever its characters.  A piece may reach
over the end of a chunk, so a chunk's state is how far behind its beginning the first
cut lies (entry) and how far behind its end (exit), at most the longest piece
less one.  The chunk's *transfer matrix* holds the best score from each entry to
each exit.  Matrices combine by the max-plus product, which is associative: blocks
of chunks first, then the blocks of a document.  That gives every chunk its entry and
exit on a best path, and the chunks are then traced back independently.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.packing import WordIds
from corpusflow.llm.textblocks import Words, arrays, mix, row_of

#: Code points beyond which a document is cut, and of a chunk; chunks of a block.
GIANT, CHUNK, BLOCK = 16_384, 8_192, 256
#: As in the library: what an unknown character costs beyond the worst piece.
UNKNOWN = 10
MARK = "▁"
_NEVER = -(1 << 60)
_NO_KEY = np.uint64((1 << 64) - 1)
#: Code points of a word up to which words are segmented together.
TOGETHER = 256
_WORDS = 1 << 14
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

OUT = "doc_id long, chunk int, start long, n_ids long, ids_crc32 long, score long, ids binary, text string"


class Beginnings:
    """A trie of pieces whose steps are looked up for many places of many texts at once: open addressing over (state, character)."""

    def __init__(self, begun: dict[str, int | None], numbers: dict[str, tuple[int, int]]):
        """``begun``: all pieces (with scores) and all beginnings of pieces (None)."""
        texts = sorted(begun, key=len)
        at = {"": 0} | {t: i for i, t in enumerate(texts, 1)}
        self.score = np.array([_NEVER] + [_NEVER if begun[t] is None else begun[t] for t in texts], np.int64)
        self.number = np.array([-1] + [numbers[t][0] if begun[t] is not None else -1 for t in texts], np.int64)
        self._shift = np.uint64(64 - max(16, (4 * len(texts)).bit_length()))
        size = 1 << (64 - int(self._shift))
        self._keys, self._to = np.full(size + 64, _NO_KEY, np.uint64), np.full(size + 64, -1, np.int64)
        self._probes = 1
        key = np.array([at[t[:-1]] << 21 | ord(t[-1]) for t in texts], np.uint64)
        for k, slot, to in zip(key.tolist(), self._slot(key).tolist(), range(1, len(texts) + 1), strict=True):
            first = slot
            while self._to[slot] >= 0:
                slot += 1
            self._keys[slot], self._to[slot] = k, to
            self._probes = max(self._probes, slot - first + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (key * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next states; -1 where no piece goes on like this."""
        key = (state << 21 | char).astype(np.uint64)
        slot = self._slot(key)
        out = np.where(self._keys[slot] == key, self._to[slot], -1)
        for probe in range(1, self._probes):
            rest = np.flatnonzero((out < 0) & (self._to[slot + probe - 1] >= 0))
            if not len(rest):
                break
            hit = rest[self._keys[slot[rest] + probe] == key[rest]]
            out[hit] = self._to[slot[hit] + probe]
        return out


class Lattice:
    """Pieces and their scores; the best segmentation of texts and of parts of texts."""

    def __init__(self, pieces: dict[str, tuple[int, int]], bytes_at: int):
        """``pieces``: number and score (whole numbers) by text; ``bytes_at``: number of the piece of byte 0."""
        self.pieces, self.bytes_at = pieces, bytes_at
        self.reach = max(map(len, pieces))
        self.unknown = min(s for _, s in pieces.values()) - UNKNOWN
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a space mark after another character")
        used = {c for p in pieces for c in p}
        self._space = np.zeros(256, bool)  # spaces, and other white space that is in no piece
        self._space[[ord(c) for c in " \t\n\r\v\f" if c == " " or c not in used]] = True
        top = max(max(n for n, _ in pieces.values()), bytes_at + 255) + 1
        self._scores = np.zeros(top, np.int64)
        # what an id spells: a piece, a byte below 128, or a byte (as a number) of a longer character
        self._spelling: list[str | int] = [""] * top
        for b in range(256):
            self._spelling[bytes_at + b] = chr(b) if b < 128 else b
        for piece, (n, score) in pieces.items():
            self._scores[n], self._spelling[n] = score, piece
        self._begun: dict[str, int | None] = {p[:i]: None for p in pieces for i in range(1, len(p))}
        self._begun.update({p: score for p, (_, score) in pieces.items()})
        self._trie = Beginnings(self._begun, pieces)
        self._known = WordIds(lambda words: [ids for i in range(0, len(words), _WORDS) for ids in self.numbers_many(words[i:i + _WORDS])])

    @classmethod
    def load(cls, path: str) -> Lattice:
        """The pieces of a SentencePiece model file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): (i, round(model.get_score(i))) for i in plain}, model.piece_to_id("<0x00>"))

    def _steps(self, text: str, end: int, least: int) -> Iterator[tuple[int, int]]:
        """(start, score) of the pieces that end at ``end`` and start at ``least`` or later, longest first."""
        get = self.pieces.get
        for start in range(max(least, end - self.reach), end):
            known = get(text[start:end])
            if known is not None:
                yield start, known[1]
            elif start == end - 1:
                yield start, self.unknown

    def path(self, text: str) -> tuple[list[int], int]:
        """Cuts of the best segmentation (without 0) and its score; of equal last pieces the longest."""
        size = len(text)
        best, back = [0] + [_NEVER] * size, [0] * (size + 1)
        get, reach, unknown = self._begun.get, self.reach, self.unknown
        for start in range(size):
            base = best[start]
            for end in range(start + 1, min(size, start + reach) + 1):
                score = get(text[start:end], _NEVER)  # None: only the beginning of pieces
                if score is None or score == _NEVER:
                    if end > start + 1:
                        if score is None:
                            continue
                        break
                    first, score = score, unknown
                else:
                    first = None
                if base + score > best[end]:
                    best[end], back[end] = base + score, start
                if first == _NEVER:
                    break
        cuts, end = [], len(text)
        while end:
            cuts.append(end)
            end = back[end]
        return cuts[::-1], best[-1]

    def _numbers(self, text: str) -> list[int]:
        """Ids of a text's best segmentation."""
        out: list[int] = []
        at = 0
        for cut in self.path(text)[0]:
            known = self.pieces.get(text[at:cut])
            out += [known[0]] if known is not None else [self.bytes_at + b for b in text[at:cut].encode()]
            at = cut
        return out

    def numbers_many(self, texts: list[str]) -> list[list[int]]:
        """Ids of the best segmentations of many words, as ``_numbers`` has them.

        The pieces at all places of all words are found length by length, and the words' best
        segmentations position by position, each step for all words at once.  Very long words,
        and those with a character that no piece has, go one by one.
        """
        out: list[list[int] | None] = [None if 0 < len(t) <= TOGETHER else self._numbers(t) for t in texts]
        todo = [i for i, x in enumerate(out) if x is None]
        if not todo:
            return out
        chars = np.frombuffer("".join(texts[i] for i in todo).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(texts[i]) for i in todo])
        word = np.repeat(np.arange(len(todo)), size)
        begin = np.cumsum(size) - size
        end = (begin + size)[word]
        # pieces as edges (start, length, state)
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        starts, lengths, states = [], [], []
        for length in range(1, self.reach + 1):
            inside = at + length <= end[at]
            at, state = at[inside], state[inside]
            state = self._trie.step(state, chars[at + length - 1])
            take = np.flatnonzero((state >= 0) & (self._trie.score[state] != _NEVER)) if length > 1 else np.arange(len(at))
            starts.append(at[take])
            lengths.append(np.full(len(take), length))
            states.append(state[take])
            at, state = at[state >= 0], state[state >= 0]
            if not len(at):
                break
        start, length, state = np.concatenate(starts), np.concatenate(lengths), np.concatenate(states)
        score = np.where(state >= 0, self._trie.score[state], _NEVER)
        unknown = score == _NEVER
        score[unknown] = self.unknown
        # every word has a node before each of its characters and one behind
        source = start + word[start]
        target = source + length
        place = (start - begin[word[start]]).astype(np.int16)
        order = np.argsort(place, kind="stable")
        best, back = np.full(len(chars) + len(todo), _NEVER, np.int64), np.full(len(chars) + len(todo), -1, np.int64)
        best[begin + np.arange(len(todo))] = 0
        for own in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            reached = best[source[own]] + score[own]
            better = reached > best[target[own]]
            own = own[better]
            best[target[own]], back[target[own]] = reached[better], own
        node = begin + size + np.arange(len(todo))
        used = []
        while len(node):
            edge = back[node]
            used.append(edge)
            node = source[edge]
            node = node[back[node] >= 0]
        edges = np.concatenate(used)
        edges = edges[np.argsort(start[edges], kind="stable")]
        odd = np.zeros(len(todo), bool)
        odd[word[start[edges[unknown[edges]]]]] = True
        numbers = self._trie.number[state[edges]].tolist()
        cut = np.searchsorted(word[start[edges]], np.arange(len(todo) + 1)).tolist()
        for j, i in enumerate(todo):
            out[i] = self._numbers(texts[i]) if odd[j] else numbers[cut[j]:cut[j + 1]]
        return out

    def encode_many(self, texts: list[str], dummy: bool) -> list[np.ndarray]:
        """Ids of plain texts (spaces as spaces), with the model's space in front if ``dummy``.

        A text is cut into words with the spaces before them, and what else stands
        between: white space that is in no piece, so all these places are sure cuts.  Only words that this worker has not met are segmented.
        """
        raw = [t.replace(MARK, " ").encode() for t in texts]
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        words = Words(data, at, self._space)
        text = row_of(words.first)
        n = len(words)
        if not n:
            return [self._plain_ids(t, dummy) for t in texts]
        start, end = words.start, words.end
        # spaces right before each word, and what stands between these and the word before
        solid = np.maximum.accumulate(np.where(data != 0x20, np.arange(len(data)), -1))
        spaces = start - 1 - np.maximum(np.where(start > 0, solid[start - 1], -1), at[text] - 1)
        begins = np.zeros(n, bool)
        begins[words.first[:-1][np.diff(words.first) > 0]] = True
        before = np.where(begins, at[text], np.concatenate([[0], end[:-1]]))
        between = start - spaces - before
        odd = np.diff(words.first) == 0
        odd[text[begins & (between > 0)]] = True
        spaces = spaces + (begins & dummy)
        last = words.first[1:][~(np.diff(words.first) == 0)] - 1
        rest = at[1:][text[last]] - end[last]
        gap, tail = np.flatnonzero(~begins & (between > 0)), last[rest > 0]
        gaps = Words.__new__(Words)
        gaps.data = data
        gaps.start = np.concatenate([before[gap], end[tail]])
        gaps.end = np.concatenate([before[gap] + between[gap], at[1:][text[tail]]])
        sorted_ = np.argsort(gaps.start, kind="stable")
        gaps.start, gaps.end = gaps.start[sorted_], gaps.end[sorted_]
        hashes = np.concatenate([mix(words.hashes() + spaces.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)),
                                 mix(gaps.hashes() ^ np.uint64(0x5851F42D4C957F2D))])
        place = np.concatenate([np.arange(n) * 3 + 1, np.concatenate([gap * 3, tail * 3 + 2])[sorted_]])
        order = np.argsort(place, kind="stable")
        whole = data.tobytes()

        def spelled(i: int) -> str:
            j = int(order[i])
            if j < n:
                return MARK * int(spaces[j]) + whole[start[j]:end[j]].decode()
            return whole[gaps.start[j - n]:gaps.end[j - n]].decode().replace(" ", MARK)

        ids, size = self._known.ids(hashes[order], spelled)
        total = np.concatenate([[0], np.cumsum(size)])
        of = text[place[order] // 3]
        edge = total[np.searchsorted(of, np.arange(len(texts) + 1))]
        return [self._plain_ids(t, dummy) if o else ids[x:y] for t, o, x, y in zip(texts, odd.tolist(), edge[:-1], edge[1:], strict=True)]

    def _plain_ids(self, text: str, dummy: bool) -> np.ndarray:
        return np.array(self._numbers((MARK if dummy and text else "") + text.replace(" ", MARK)), np.uint32)

    def score(self, ids: np.ndarray) -> int:
        """Score of a segmentation: an unknown character counts once, at its first byte."""
        raw = ids.astype(np.int64) - self.bytes_at
        is_byte = (raw >= 0) & (raw < 256)
        unknown = int((is_byte & ((raw & 0xC0) != 0x80)).sum())
        return int(self._scores[ids[~is_byte]].sum()) + unknown * self.unknown

    def encode(self, text: str) -> tuple[bytes, int]:
        """Ids and score of a prepared text (or of a part between two cuts)."""
        ids = self.encode_many([text.replace(MARK, " ")], False)[0]
        return ids.astype("<u4").tobytes(), self.score(ids)

    def decode(self, ids: bytes) -> str:
        """The prepared text again."""
        out = [self._spelling[n] for n in np.frombuffer(ids, "<u4").tolist()]
        if not any(isinstance(x, int) for x in out):
            return "".join(out)
        text, raw = [], bytearray()
        for x in out:
            if isinstance(x, int):
                raw.append(x)
                continue
            if raw:
                text.append(raw.decode(errors="replace"))
                raw.clear()
            text.append(x)
        return "".join(text) + raw.decode(errors="replace")

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Best scores from each entry to each exit of the chunk text[:size]; text goes on up to reach - 1 further.

        Entry e: the first cut is at e; exit f: the first cut at or behind ``size`` is at size + f.
        """
        return self.matrices([text], [size])[0]

    def matrices(self, texts: list[str], sizes: list[int]) -> list[np.ndarray]:
        """The matrices of many chunks; what stands between the first and the last sure cut of each is encoded together."""
        cuts = [[m.start() for m in _UNIT.finditer(text) if m.start() and m.start() <= size and text[m.start() - 1] != MARK]
                for text, size in zip(texts, sizes, strict=True)]
        middles = self.encode_many([text[own[0]:own[-1]].replace(MARK, " ") if own else "" for text, own in zip(texts, cuts, strict=True)], False)
        found = []
        for text, size, own, middle in zip(texts, sizes, cuts, middles, strict=True):
            if not own:
                found.append(self._transfer(text, size, self.reach))
                continue
            first, last = own[0], own[-1]
            head = self._transfer(text[:first], first, self.reach)[:, 0]
            tail = self._transfer(text[last:], size - last, 1)[0]
            out = head[:, None] + self.score(middle) + tail[None, :]
            out[(head <= _NEVER // 2)[:, None] | (tail <= _NEVER // 2)[None, :]] = _NEVER
            found.append(out)
        return found

    def _transfer(self, text: str, size: int, entries: int) -> np.ndarray:
        """As ``matrix``, position by position, for all entries at once."""
        best = np.full((len(text) + 1, entries), _NEVER, np.int64)
        for e in range(min(entries, len(text) + 1)):
            best[e, e] = 0
        for end in range(1, len(text) + 1):
            # a cut behind the chunk's end is the first there: its piece starts inside
            for start, score in self._steps(text, end, 0):
                if start < size:
                    np.maximum(best[end], best[start] + score, out=best[end])
        out = np.full((entries, self.reach), _NEVER, np.int64)
        upto = best[size:size + self.reach].T
        out[:, :upto.shape[1]] = upto
        for e in range(min(entries, self.reach)):
            if e > size:  # a piece over the whole chunk
                out[e] = _NEVER
                out[e, e - size] = 0
        return np.maximum(out, _NEVER)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two transfer matrices (associative)."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), _NEVER)


def trace_states(matrices: list[np.ndarray], entry: int, exit_: int) -> list[tuple[int, int]]:
    """(entry, exit) of each part on a best path from ``entry`` of the first to ``exit_`` of the last."""
    behind = [np.full(len(matrices[0]), _NEVER, np.int64)]
    behind[0][exit_] = 0
    for m in reversed(matrices):
        behind.append(np.maximum((m + behind[-1][None, :]).max(1), _NEVER))
    out, at = [], entry
    for m, rest in zip(matrices, behind[-2::-1], strict=True):
        to = int((m[at] + rest).argmax())
        out.append((at, to))
        at = to
    return out


def prepared(text: str | None) -> str:
    """The text as the pieces spell it; empty if it is null or empty."""
    return MARK + text.replace(" ", MARK) if text else ""


def plain(text: str) -> str:
    """The text of a prepared text."""
    return text.replace(MARK, " ")[1:]


_LATTICES: dict[str, Lattice] = {}


def _lattice(path: str) -> Lattice:
    """This worker's lattice of a model file."""
    if path not in _LATTICES:
        _LATTICES[path] = Lattice.load(path)
    return _LATTICES[path]


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about a megabyte of text."""
    offsets, _ = arrays(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20), side="right")) - 1))
        yield lo, hi
        lo = hi


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    names = [c.split()[0] for c in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _row(lattice: Lattice, doc_id: int | None, chunk: int, start: int, ids: np.ndarray) -> tuple:
    raw = ids.astype("<u4").tobytes()
    text = lattice.decode(raw).replace(MARK, " ")
    return doc_id, chunk, start, len(ids), zlib.crc32(raw), lattice.score(ids), raw, text if start else text[1:]


def _whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path)
        for batch in batches:
            for lo, hi in _parts(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                ids = lattice.encode_many(texts, True)
                yield _batch([_row(lattice, d, 0, 0, i) for d, i in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), ids, strict=True)])
    return run


def _cut(path: str):
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary())
    names = ["doc_id", "row", "chunk", "chunks", "part", "matrix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path)

        def done(rows: list[tuple]) -> pa.RecordBatch:
            found = lattice.matrices([r[4] for r in rows], [r[5] for r in rows])
            columns = [*list(zip(*rows, strict=True))[:5], [m.astype("<i8").tobytes() for m in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            rows: list[tuple] = []
            for doc_id, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = prepared(text)
                starts = range(0, len(text), CHUNK)
                for chunk, at in enumerate(starts):
                    rows.append((doc_id, row, chunk, len(starts), text[at:at + CHUNK + lattice.reach - 1], min(CHUNK, len(text) - at)))
                    if len(rows) == 100:
                        yield done(rows)
                        rows = []
            if rows:
                yield done(rows)
    return run


def _square(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw, "<i8")
    return flat.reshape(int(len(flat) ** 0.5), -1)


def _trace(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(path)
        for batch in batches:
            doc_id, chunk, part, entry, exit_ = (c.to_pylist() for c in batch.columns)
            for lo in range(0, len(part), 100):
                own = range(lo, min(lo + 100, len(part)))
                ids = lattice.encode_many([part[i][entry[i]:min(CHUNK, len(part[i])) + exit_[i]].replace(MARK, " ") for i in own], False)
                yield _batch([_row(lattice, doc_id[i], chunk[i], chunk[i] * CHUNK + entry[i], x) for i, x in zip(own, ids, strict=True)])
    return run


def _states(chunks: DataFrame) -> DataFrame:
    """``(row, chunk, entry, exit)`` from the chunks' matrices: products of blocks, states of blocks, states of chunks."""
    import pandas as pd

    def product(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for raw in rows.sort_values("chunk")["matrix"]:
            total = _square(raw) if total is None else max_plus(total, _square(raw))
        return pd.DataFrame({"row": [key[0]], "block": [key[1]], "matrix": [total.astype("<i8").tobytes()]})

    def over_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        found = trace_states([_square(raw) for raw in rows["matrix"]], 0, 0)
        return pd.DataFrame({"row": key[0], "block": rows["block"], "entry": [a for a, _ in found], "exit": [b for _, b in found]})

    def over_chunks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        found = trace_states([_square(raw) for raw in rows["matrix"]], int(rows["entry"].iloc[0]), int(rows["exit"].iloc[0]))
        return pd.DataFrame({"row": key[0], "chunk": rows["chunk"], "entry": [a for a, _ in found], "exit": [b for _, b in found]})

    parts = chunks.select("row", "chunk", "matrix", F.floor(F.col("chunk") / BLOCK).cast("int").alias("block"))
    blocks = parts.groupBy("row", "block").applyInPandas(product, "row long, block int, matrix binary") \
        .groupBy("row").applyInPandas(over_blocks, "row long, block int, entry int, exit int")
    return parts.join(blocks, ["row", "block"]).groupBy("row", "block") \
        .applyInPandas(over_chunks, "row long, chunk int, entry int, exit int")


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk, in the columns of OUT; a document of up to GIANT code points is one chunk.

    ``start``: place of the chunk's first cut in the prepared text; ``ids``: little-endian
    unsigned 32-bit numbers, which together are the document's; ``text``: decoded from
    them, together the document's text again (but U+2581 comes back as a space).

    Of equally good segmentations, the one that a giant document gets can depend on CHUNK.

    Defined cases: a null or empty text has one chunk without ids; rows with a null
    id and repeated rows are encoded like any others; an empty table gives no rows;
    other columns are ignored.  ``model_path`` must be readable on every executor.
    """
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    small = docs.filter(size <= GIANT).mapInArrow(_whole(model_path), OUT)
    giant = docs.filter(size > GIANT).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    chunks = staged(giant.mapInArrow(_cut(model_path), "doc_id long, row long, chunk int, chunks int, part string, matrix binary"),
                    "piece-chunks")
    traced = chunks.select("doc_id", "row", "chunk", "part").join(_states(chunks).hint("merge"), ["row", "chunk"]) \
        .select("doc_id", "chunk", "part", "entry", "exit").mapInArrow(_trace(model_path), OUT)
    return small.unionAll(traced)
