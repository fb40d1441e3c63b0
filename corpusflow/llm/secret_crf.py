"""Secret scans with a linear-chain conditional random field.

Three fixed patterns find the well-known shapes of secrets; the field adds spans
that have no fixed shape.  It tags every token of every whole text as *begin*,
*inside* or *outside*, from the token's shape, the neighbouring tokens and the
text's own proportions, and is decoded by Viterbi.

Features are computed for all tokens of a block at once, and so are the scores.
Where *outside* beats the other tags by more than all transitions could make up,
it is on the best path whatever its neighbours are; such tokens cut a text into
short runs, and only those need the recursion.  The cut is exact.

The field is trained on a bounded sample (TRAIN_DOCS documents of at most
TRAIN_CHARS characters, labelled by the fixed patterns) and on made-up
assignments with secrets of many kinds (TRAIN_LINES lines).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import workers_ready
from corpusflow.llm.textblocks import Words, blocks, mix

KINDS = ("assign", "access", "hex", "model")
#: The sample that the field is trained on.
TRAIN_DOCS, TRAIN_CHARS, TRAIN_LINES = 300, 20_000, 1_500
MIN_SPAN = 8
OUT, BEGIN, INSIDE = 0, 1, 2
_TRAIN_LENGTH = 30
_ROUNDS = 40
_BUCKETS = 1 << 12

# Fixed patterns, on bytes lower-cased in A-Z for the first (its groups match in either case).
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.full(256, 6, np.int64)  # 0 lower, 1 upper, 2 digit, 3 wide, 4 joining mark, 5 space, 6 other mark
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[list(b"_-+/")] = 4
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdefABCDEF")] = True
_LENGTHS = np.array([2, 4, 8, 12, 16, 20, 32, 40, 64])

#: Sizes of the feature groups.
GROUPS = {"shape": 320, "mixture": 40, "word": _BUCKETS, "before": _BUCKETS, "before_2": _BUCKETS, "after": _BUCKETS,
          "shape_before": 320, "shape_after": 320, "gap": 2, "file": 27}


class Tokens:
    """Runs of letters, digits, wide characters and _-+/, and single other marks, of all texts of a block."""

    def __init__(self, words: Words):
        data = words.data
        kind = _KIND[data]
        solid = kind < 5
        start = kind != 5
        start[1:] &= ~(solid[1:] & solid[:-1])
        cut = words.text_at[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        start[cut] = kind[cut] != 5
        last = kind != 5
        last[:-1] &= ~(solid[:-1] & solid[1:])
        last[cut - 1] = kind[cut - 1] != 5
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, words.text_at)
        self._words, self._kind = words, kind

    def features(self) -> np.ndarray:
        """One number per token and feature group, or -1 for none."""
        words, kind, s, e = self._words, self._kind, self.start, self.end
        n, size = len(s), self.end - self.start

        def count(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[e] - total[s]

        lower, upper, digit = count(kind == 0), count(kind == 1), count(kind == 2)
        other = size - lower - upper - digit
        hexes = count(_HEX_BYTE[words.data])
        changes = np.zeros(len(kind), bool)
        changes[1:] = kind[1:] != kind[:-1]
        changes[s] = False
        turns = count(changes)
        long = np.searchsorted(_LENGTHS, size, side="right")
        shape = ((((long * 2 + (lower > 0)) * 2 + (upper > 0)) * 2 + (digit > 0)) * 2 + (other > 0)) * 2 + (hexes == size)
        share = np.minimum(4, np.ceil(digit * 4 / size).astype(np.int64))
        mixture = share * 8 + np.minimum(7, turns * 16 // size)
        spare = Words.__new__(Words)
        spare.data, spare.start, spare.end = words.data, s, e
        name = (spare.hashes(_LOWER[words.data]) >> np.uint64(40)).astype(np.int64) & (_BUCKETS - 1)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

        def shifted(values: np.ndarray, by: int) -> np.ndarray:
            out = np.full(n, -1, np.int64)
            a, b = (slice(by, None), slice(None, -by)) if by > 0 else (slice(None, by), slice(-by, None))
            if n > abs(by):
                out[a] = np.where(text[a] == text[b], values[b], -1)
            return out

        gap = np.ones(n, np.int64)
        gap[1:] = s[1:] > e[:-1]
        letters = np.maximum(1, np.bincount(text, weights=size, minlength=len(self.first) - 1))

        def level(of: np.ndarray, bounds: tuple[float, float]) -> np.ndarray:
            return np.searchsorted(bounds, np.bincount(text, weights=of, minlength=len(letters)) / letters)

        file = level(digit, (0.02, 0.1)) * 9 + level(upper, (0.05, 0.3)) * 3 + level(kind[s] == 6, (0.05, 0.15))
        return np.stack([shape, mixture, name, shifted(name, 1), shifted(name, 2), shifted(name, -1),
                         shifted(shape, 1), shifted(shape, -1), gap, file[text]], 1)


@dataclass
class Field:
    """Weights of a linear-chain field: per feature value and tag, per pair of tags, per first tag."""

    state: np.ndarray
    pair: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Score of each tag at each token."""
        out = np.zeros((len(features), 3))
        for column, at in zip(features.T, _OFFSETS, strict=True):
            out += self.state[np.where(column < 0, len(self.state) - 1, column + at)]
        return out

    def decode(self, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The best tags; ``begins`` says which tokens are the first of a text."""
        tags = np.zeros(len(scores), np.int8)
        # beyond this margin, OUT is best whatever stands beside it
        margin = 2 * (self.pair.max() - self.pair.min()) + (self.first.max() - self.first.min())
        free = np.flatnonzero(scores[:, OUT] - scores[:, 1:].max(1, initial=-np.inf) <= margin)
        if not len(free):
            return tags
        cuts = np.flatnonzero((np.diff(free) > 1) | begins[free[1:]]) + 1
        for run in np.split(free, cuts):
            a, b = int(run[0]), int(run[-1]) + 1
            closed = b < len(tags) and not begins[b]  # an OUT stands behind, as one stands before
            tags[a:b] = self._best(scores[a:b], None if begins[a] else OUT, OUT if closed else None)
        return tags

    def _best(self, scores: np.ndarray, before: int | None, behind: int | None) -> np.ndarray:
        best = scores[0] + (self.first if before is None else self.pair[before])
        back = np.zeros((len(scores), 3), np.int8)
        for t in range(1, len(scores)):
            reach = best[:, None] + self.pair
            back[t] = reach.argmax(0)
            best = reach.max(0) + scores[t]
        tag = int((best if behind is None else best + self.pair[:, behind]).argmax())
        out = np.empty(len(scores), np.int8)
        for t in range(len(scores) - 1, -1, -1):
            out[t] = tag
            tag = back[t, tag]
        return out


_OFFSETS = np.concatenate([[0], np.cumsum(list(GROUPS.values()))[:-1]])
_STATES = int(sum(GROUPS.values()))


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns, leftmost and not overlapping per kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(raw.lower()) if m.end(1) - m.start(1) >= 8]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(raw) if m.end() - m.start() >= 16]
    return out + [(m.start(), 2, m.end()) for m in _HEX.finditer(raw)]


def model_spans(field: Field, words: Words) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) in bytes of the block: runs of begin and inside tags without white space between."""
    tokens = Tokens(words)
    if not len(tokens.start):
        return
    begins = np.zeros(len(tokens.start) + 1, bool)
    begins[tokens.first[:-1]] = True
    begins = begins[:-1]
    tags = field.decode(field.scores(tokens.features()), begins)
    inside = np.flatnonzero(tags != OUT)
    if not len(inside):
        return
    new = np.ones(len(inside), bool)
    new[1:] = (tags[inside[1:]] == BEGIN) | (inside[1:] != inside[:-1] + 1) | begins[inside[1:]] \
        | (tokens.start[inside[1:]] != tokens.end[inside[:-1]])
    head = np.flatnonzero(new)
    start = tokens.start[inside[head]]
    end = tokens.end[inside[np.append(head[1:], len(inside)) - 1]]
    text = np.searchsorted(words.text_at, start, side="right") - 1
    yield from zip(text.tolist(), start.tolist(), end.tolist(), strict=True)


def block_spans(field: Field, words: Words) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Per text: its base spans, and all its spans, as sorted (start, kind, end) in code points."""
    data = words.data
    found: dict[int, list[tuple[int, int]]] = {}
    for text, a, b in model_spans(field, words):
        found.setdefault(text, []).append((a, b))
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    raw = data.tobytes()
    for i, (lo, hi) in enumerate(zip(words.text_at[:-1].tolist(), words.text_at[1:].tolist(), strict=True)):
        base = sorted(base_spans(raw[lo:hi]))
        every = base
        if i in found:
            more = []
            for a, b in found[i]:
                a, b = a - lo, b - lo
                if point[lo + b] - point[lo + a] >= MIN_SPAN and not any(x < b and a < y for x, _, y in base):
                    more.append((a, 3, b))
            every = sorted(base + more)
        at = point[lo]
        yield tuple([(int(point[lo + a] - at), k, int(point[lo + b] - at)) for a, k, b in own] for own in (base, every))


def train(samples: list[tuple[str, list[tuple[int, int]]]], seed: int = 7) -> Field:
    """Fit a field to texts with secret spans (code points), by gradient ascent on the log-likelihood."""
    pieces = []
    for text, spans in samples:
        raw = text.encode()
        words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        tokens = Tokens(words)
        n = len(tokens.start)
        if not n:
            continue
        tags = np.zeros(n, np.int64)
        at = np.concatenate([np.cumsum((words.data & 0xC0) != 0x80), [len(text) + 1]]) - 1
        for a, b in spans:
            own = np.flatnonzero((at[tokens.start] >= a) & (at[tokens.end - 1] < b))
            tags[own] = INSIDE
            tags[own[:1]] = BEGIN
        features = tokens.features()
        for lo in range(0, n, _TRAIN_LENGTH):
            pieces.append((features[lo:lo + _TRAIN_LENGTH], tags[lo:lo + _TRAIN_LENGTH]))
    if len(pieces) > 4000:
        marked = [p for p in pieces if p[1].any()]
        rest = [p for p in pieces if not p[1].any()]
        random.Random(seed).shuffle(rest)
        pieces = marked + rest[:2000]
    n = len(pieces)
    x = np.full((n, _TRAIN_LENGTH, len(GROUPS)), -1, np.int64)
    y = np.zeros((n, _TRAIN_LENGTH), np.int64)
    real = np.zeros((n, _TRAIN_LENGTH), bool)
    for i, (f, t) in enumerate(pieces):
        x[i, :len(t)], y[i, :len(t)], real[i, :len(t)] = f, t, True
    index = np.where(x < 0, _STATES, x + _OFFSETS)
    field = Field(np.zeros((_STATES + 1, 3)), np.zeros((3, 3)), np.zeros(3))
    flat = index[real].ravel()
    seen = np.repeat(real.sum(), 1)[0]
    truth = np.eye(3)[y]
    pairs = np.einsum("nti,ntj,nt->ij", truth[:, :-1], truth[:, 1:], real[:, 1:].astype(float))
    firsts = truth[:, 0].sum(0)
    speed = [np.zeros_like(w) for w in (field.state, field.pair, field.first)]
    for _ in range(_ROUNDS):
        score = field.state[index].sum(2)
        ahead = np.zeros((_TRAIN_LENGTH, n, 3))
        back = np.zeros((_TRAIN_LENGTH, n, 3))
        ahead[0] = score[:, 0] + field.first
        for t in range(1, _TRAIN_LENGTH):
            step = _logsum(ahead[t - 1][:, :, None] + field.pair, 1) + score[:, t]
            ahead[t] = np.where(real[:, t, None], step, ahead[t - 1])
        for t in range(_TRAIN_LENGTH - 2, -1, -1):
            step = _logsum(field.pair + (back[t + 1] + score[:, t + 1])[:, None, :], 2)
            back[t] = np.where(real[:, t + 1, None], step, 0)
        total = _logsum(ahead[-1], 1)
        share = np.exp(np.swapaxes(ahead + back, 0, 1) - total[:, None, None])
        error = ((truth - share) * real[:, :, None])[real]
        state = np.stack([np.bincount(flat, np.repeat(error[:, k], len(GROUPS)), _STATES + 1) for k in range(3)], 1)
        state[-1] = 0
        joint = np.zeros((3, 3))
        for t in range(1, _TRAIN_LENGTH):
            p = np.exp(ahead[t - 1][:, :, None] + field.pair + (score[:, t] + back[t])[:, None, :] - total[:, None, None])
            joint += p[real[:, t]].sum(0)
        for weight, gradient, sum_2 in zip((field.state, field.pair, field.first),
                                           (state, pairs - joint, firsts - share[:, 0].sum(0)), speed, strict=True):
            gradient = gradient - 0.5 * weight  # a normal prior
            sum_2 += gradient ** 2
            weight += 0.5 * gradient / np.sqrt(sum_2 + 1e-6 * seen)
    return field


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def made_up_lines(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int]]]]:
    """Assignments with secrets of many kinds, and lookalikes without one, as (text, spans of the values)."""
    rnd = random.Random(seed)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    names = ["password", "passwd", "pwd", "passphrase", "secret", "client_secret", "token", "auth_token", "access_token",
             "api_key", "apikey", "API key", "private key", "credential", "bearer", "Authorization: Bearer", "signing key",
             "session key", "refresh token", "aws_secret_access_key", "db_pass", "DB_PASSWORD", "license key", "webhook secret"]
    plain = ["version", "name", "page", "date", "phone", "user", "id", "title", "count", "path", "colour", "email", "order", "isbn"]
    talk = "the of and to in is that it on for with as was by this be are from or an at we you not have but".split()

    def secret() -> str:
        kind = rnd.randrange(6)
        size = rnd.randrange(12, 48)
        if kind == 0:
            return "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([24, 32, 40, 64])))
        if kind == 1:
            return "".join(rnd.choice("0123456789ABCDEF") for _ in range(rnd.choice([32, 40, 64])))
        if kind == 2:
            return "-".join("".join(rnd.choice("0123456789abcdef") for _ in range(k)) for k in (8, 4, 4, 4, 12))
        if kind == 3:
            return rnd.choice(["sk_live_", "ghp_", "xoxb-", "SG.", "eyJ"]) + "".join(rnd.choice(alnum) for _ in range(size))
        if kind == 4:
            return "".join(rnd.choice(alnum + "+/") for _ in range(size)) + rnd.choice(["", "=", "=="])
        return "".join(rnd.choice(alnum) for _ in range(size))

    def value() -> str:
        kind = rnd.randrange(7)
        if kind == 0:
            return "".join(rnd.choice("0123456789") for _ in range(rnd.choice([4, 8, 13, 16])))
        if kind == 1:
            return f"+{rnd.randrange(1, 99)} ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)}"
        if kind == 2:
            return f"{rnd.choice(talk)}{rnd.choice(talk)}.{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com"
        if kind == 3:
            return f"https://{rnd.choice(talk)}.example.org/{rnd.choice(talk)}/{rnd.randrange(99999)}?page={rnd.randrange(9)}"
        if kind == 4:
            return f"{rnd.randrange(1990, 2030)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}"
        if kind == 5:
            return "".join(rnd.choice(talk) for _ in range(rnd.randrange(2, 9)))
        return f"{rnd.randrange(9)}.{rnd.randrange(99)}.{rnd.randrange(99)}"

    out = []
    for _ in range(n):
        head = " ".join(rnd.choice(talk) for _ in range(rnd.randrange(0, 9)))
        tail = " ".join(rnd.choice(talk) for _ in range(rnd.randrange(0, 9)))
        real = rnd.random() < 0.5
        name = rnd.choice(names if real or rnd.random() < 0.3 else plain)
        body = secret() if real else value()
        quote = rnd.choice(['"', "'", "", "", "`"])
        left = f"{head} {name}{rnd.choice([' = ', '=', ': ', ' is ', ' := ', ' -> ', ' '])}{quote}".lstrip()
        out.append((f"{left}{body}{quote}{rnd.choice(['', '.', ',', ';'])} {tail}", [(len(left), len(left) + len(body))] if real else []))
    return out


def _labelled(text: str) -> tuple[str, list[tuple[int, int]]]:
    """A text with the values that the fixed patterns find."""
    spans = []
    raw = text.encode()
    point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    for m in _ASSIGN.finditer(raw.lower()):
        if m.end(1) - m.start(1) >= 8:
            spans.append((int(point[m.start(1)]), int(point[m.end(1)])))
    for pattern, least in ((_ACCESS, 16), (_HEX, 32)):
        spans += [(int(point[m.start()]), int(point[m.end()])) for m in pattern.finditer(raw) if m.end() - m.start() >= least]
    return text, spans


def fit(docs: DataFrame, text_col: str = "text") -> Field:
    """A field trained on at most TRAIN_DOCS different texts of ``docs`` (of least hash) and TRAIN_LINES made-up lines.

    The texts are counted first, so that only those under a hash that lets about
    half as many again through are gathered, whatever the number of tasks.
    """
    short = docs.select(F.col(text_col).alias("text")).filter(F.length("text").between(1, TRAIN_CHARS))
    share = min(1.0, 1.5 * TRAIN_DOCS / max(1, short.count()))
    low = short.withColumn("hash", F.pmod(F.xxhash64("text"), F.lit(1 << 32))).filter(F.col("hash") <= int(share * (1 << 32)))
    rows = low.groupBy("hash").agg(F.min("text").alias("text")).orderBy("hash").limit(TRAIN_DOCS).collect()
    return train([_labelled(r["text"]) for r in rows] + made_up_lines(TRAIN_LINES))


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(field: Field):
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_model", "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in blocks(batch.column(1)):
                both = list(block_spans(field, words))
                count = [[sum(k == kind for _, k, _ in every) for _, every in both] for kind in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in count),
                     pa.array([_said(base) for base, _ in both], pa.string()),
                     pa.array([_said(every) for _, every in both], pa.string())], names)
    return run


def scan(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, n_model, base, spans``.

    ``base`` and ``spans`` list the spans of the fixed patterns and all spans, as
    ``kind:start:end`` in code points (the whole match; end exclusive), by start,
    then in the order of KINDS, joined by commas.  The field's spans are those of
    at least MIN_SPAN code points that overlap none of a fixed pattern.

    Defined cases: a null or empty text has none; rows with a null id and repeated
    rows are scanned like any others; an empty table gives no rows; other columns
    are ignored.
    """
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_scan(field or fit(docs)), "doc_id long, n_assign long, n_access long, n_hex long, n_model long, "
                                                      "base string, spans string")


def _redact(field: Field, text_at: int, chars_at: int | None, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for lo, hi, words in blocks(batch.column(text_at)):
                for i, (_, spans) in enumerate(block_spans(field, words), lo):
                    if not spans:
                        continue
                    out, at = [], 0
                    for a, _, b in spans:
                        if a >= at:
                            out += [texts[i][at:a], mark]
                        at = max(at, b)
                    texts[i] = "".join(out) + texts[i][at:]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            if chars_at is not None:
                columns[chars_at] = pa.array([None if t is None else len(t) for t in texts]).cast(batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return run


def redact(docs: DataFrame, field: Field | None = None, mark: str = "[secret]", text_col: str = "text",
           chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with every span (overlapping ones together) replaced by ``mark``.

    ``chars_col``, if there is such a column, gets the new number of code points.
    """
    docs = workers_ready(docs)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None
    return docs.mapInArrow(_redact(field or fit(docs, text_col), docs.columns.index(text_col), chars_at, mark), docs.schema)
