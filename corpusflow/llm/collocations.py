"""Phrase collocations: how often phrases occur, level by level, and how strongly their parts hold together.

Counting is by double-array tries.  The candidates of one length, all of whose
parts are frequent, are dealt out by their hash to tries of about TRIE phrases;
ROUND_TRIES of them at a time are broadcast (some 3 MB each), and every text
advances the states of all its positions at once, level by level, in numpy.
Accepting states are counted by ``bincount`` in the task and summed by Spark.
The positions that accept also say which longer phrases have frequent parts: these
go out as (phrase, next word) with a count, and sums of at least the least count
are the candidates of the next length.  No candidate is left out, so counts are whole.

Words are known by 64-bit hashes of (language, word).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.textblocks import Words, arrays, gram_hashes, mix, row_of

MIN_COUNT, LONGEST, TOP, INSIDE = 10, 3, 2000, 50
#: Phrases of one trie, and tries of one broadcast.
TRIE, ROUND_TRIES = 50_000, 16
BLOCK = 1_500_000
_SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE_END = np.zeros(256, bool)
_PIECE_END[list(b".,;:!?\n\v\f\r")] = True
_WORD_END = _PIECE_END.copy()
_WORD_END[[0x20, 0x09]] = True


def double_array(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and the final states of a trie of equally long paths.

    ``paths``: rows of symbols from 1, sorted and different.  From state s, symbol c
    leads to ``t = base[s] + c`` if ``check[t] == s``; state 0 is the root.
    """
    n, depth = paths.shape
    room = 2 * n * depth + int(paths.max(initial=0)) + 4096
    base, check, free = np.zeros(room, np.int64), np.full(room, -2, np.int64), np.ones(room, bool)
    free[0], check[0] = False, -1
    state = np.zeros(n, np.int64)
    lowest = 1
    for level in range(depth):
        symbol = paths[:, level]
        new = np.ones(n, bool)
        new[1:] = (state[1:] != state[:-1]) | (symbol[1:] != symbol[:-1])
        head = np.flatnonzero(new)
        parent, c = state[head], symbol[head]
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        size = np.diff(np.r_[first, len(head)])
        slot = np.empty(len(head), np.int64)
        for g in np.flatnonzero(size > 1)[np.argsort(-size[size > 1], kind="stable")].tolist():
            own = slice(first[g], first[g] + size[g])
            step = c[own] - c[own][0]
            at = lowest
            while True:
                while at + 4096 + step[-1] >= len(free):
                    base, check, free = (np.r_[x, np.full(len(x), fill, x.dtype)] for x, fill in ((base, 0), (check, -2), (free, True)))
                tries = at + np.flatnonzero(free[at:at + 4096])[:max(1, (1 << 20) // len(step))]
                fits = tries[free[tries[:, None] + step].all(1)] if len(tries) else tries
                if len(fits):
                    slot[own] = fits[0] + step
                    free[slot[own]] = False
                    break
                at = int(tries[-1]) + 1 if len(tries) else at + 4096
            while not free[lowest]:
                lowest += 1
        alone = first[size == 1]
        while True:
            gaps = np.flatnonzero(free)
            if len(gaps) > len(alone):
                break
            base, check, free = (np.r_[x, np.full(len(x), fill, x.dtype)] for x, fill in ((base, 0), (check, -2), (free, True)))
        slot[alone] = gaps[:len(alone)]
        free[slot[alone]] = False
        base[parent] = slot - c
        check[slot] = parent
        state = slot[np.cumsum(new) - 1]
        while not free[lowest]:
            lowest += 1
    used = int(state.max(initial=0)) + 1
    used = max(used, int(np.flatnonzero(check > -2)[-1]) + 1)
    return base[:used].astype(np.int32), check[:used].astype(np.int32), state.astype(np.int32)


class Trie:
    """A double-array trie of phrases of one length over its own vocabulary of word hashes."""

    def __init__(self, vocabulary: np.ndarray, base: np.ndarray, check: np.ndarray, final: np.ndarray, phrases: np.ndarray):
        """``final``: the accepting states; ``phrases``: their phrases' hashes."""
        self.vocabulary, self.base, self.check, self.final, self.phrases = vocabulary, base, check, final, phrases

    @classmethod
    def of(cls, words: np.ndarray, phrases: np.ndarray) -> Trie:
        """From rows of word hashes and the phrases' own hashes."""
        vocabulary, symbol = np.unique(words, return_inverse=True)
        paths = symbol.reshape(words.shape).astype(np.int64) + 1
        order = np.lexsort(paths.T[::-1])
        return cls(vocabulary, *double_array(paths[order]), phrases[order])

    def advance(self, words: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The positions among ``at`` from which ``depth`` words lead to a state, and those states."""
        state = np.zeros(len(at), np.int64)
        for level in range(depth):
            own = words[at + level]
            place = np.minimum(np.searchsorted(self.vocabulary, own), len(self.vocabulary) - 1)
            to = self.base[state] + place + 1
            inside = (self.vocabulary[place] == own) & (to >= 0) & (to < len(self.check))
            inside[inside] = self.check[to[inside]] == state[inside]
            at, state = at[inside], to[inside]
        return at, state


def text_words(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[str], np.ndarray]]:
    """Blocks of rows (lang, text): words, their hashes, their pieces' numbers, the languages and each word's language."""
    offsets, raw = arrays(batch.column(1))
    langs = batch.column(0).dictionary_encode()
    names = langs.dictionary.to_pylist()
    code = np.asarray(langs.indices)
    seed = np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], np.uint64)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, side="right")) - 1))
        words = Words(_LOWER[raw[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo], _WORD_END)
        row = row_of(words.first)
        own = code[lo:hi][row]
        piece = np.cumsum(_PIECE_END[words.data])[words.start] + row if len(words) else row
        yield words, mix(words.hashes() ^ seed[own]) if len(words) else np.zeros(0, np.uint64), piece, names, own
        lo = hi


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word hash, word, n), and without a word, all of a language."""
    for batch in batches:
        for words, hashes, _, names, lang in text_words(batch):
            _, head, n = np.unique(hashes, return_index=True, return_counts=True)
            total = np.bincount(lang, minlength=len(names))
            raw = words.data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(words.start[head].tolist(), words.end[head].tolist(), strict=True)]
            said = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([
                pa.array([names[i] for i in lang[head].tolist()] + [names[i] for i in said.tolist()], pa.string()),
                pa.array(np.r_[hashes[head], np.zeros(len(said), np.uint64)].view(np.int64)),
                pa.array(texts + [None] * len(said), pa.string()), pa.array(np.r_[n, total[said]].astype(np.int64))],
                ["lang", "word", "text", "n"])


def _build(table: pa.Table) -> pa.Table:
    """One trie from rows (shard, hash, parts)."""
    parts = table.column("parts").combine_chunks()
    phrases = table.column("hash").to_numpy().view(np.uint64)
    trie = Trie.of(parts.flatten().to_numpy().view(np.uint64).reshape(len(parts), -1), phrases)
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                     **{k: pa.array([getattr(trie, k).tobytes()], pa.binary()) for k in ("vocabulary", "base", "check", "final", "phrases")}})


_TYPES = {"vocabulary": np.uint64, "base": np.int32, "check": np.int32, "final": np.int32, "phrases": np.uint64}


def _count(tries, shards: int, depth: int, go_on: bool):
    """Texts to counts: (phrase, null, n) of the broadcast tries' phrases, and (phrase, next word, n) of what may follow them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {s: Trie(**{k: np.frombuffer(v, _TYPES[k]) for k, v in row.items()}) for s, row in tries.value.items()}
        here = np.zeros(shards, bool)
        here[list(own)] = True
        sums = {s: np.zeros(len(t.check), np.int64) for s, t in own.items()}
        for batch in batches:
            for words, hashes, piece, _, _ in text_words(batch):
                if len(hashes) < depth:
                    continue
                phrase = gram_hashes(hashes, depth)
                shard = ((phrase >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)
                known = here[shard]
                at = np.flatnonzero(known & (piece[:len(phrase)] == piece[depth - 1:]))
                at = at[np.argsort(shard[at], kind="stable")]
                accepts = np.zeros(len(phrase), bool)
                for part in np.split(at, np.flatnonzero(np.diff(shard[at])) + 1) if len(at) else ():
                    s = int(shard[part[0]])
                    hit, state = own[s].advance(hashes, part, depth)
                    accepts[hit] = True
                    sums[s] += np.bincount(state, minlength=len(sums[s]))
                if not go_on:
                    continue
                # the phrase here is a candidate, and the one a word further is or may be
                on = np.flatnonzero(accepts[:-1] & (accepts[1:] | ~known[1:]) & (piece[:len(phrase) - 1] == piece[depth:]))
                _, head, n = np.unique(gram_hashes(hashes, depth + 1)[on], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(phrase[on[head]].view(np.int64)), pa.array(hashes[on[head] + depth].view(np.int64)),
                                                  pa.array(n.astype(np.int64))], ["hash", "word", "n"])
        for s, trie in own.items():
            seen = np.flatnonzero(sums[s][trie.final])
            yield pa.RecordBatch.from_arrays([pa.array(trie.phrases[seen].view(np.int64)), pa.nulls(len(seen), pa.int64()),
                                              pa.array(sums[s][trie.final[seen]])], ["hash", "word", "n"])
    return run


def _level(texts: DataFrame, candidates: DataFrame, depth: int, go_on: bool, least: int, trie: int) -> DataFrame:
    """(hash, word, n): exact counts of the candidates (no word), and those of their continuations of at least ``least``."""
    spark = texts.sparkSession
    shards = max(1, -(-candidates.count() // trie))
    dealt = candidates.select(F.expr(f"shiftrightunsigned(hash, 1) % {shards}").alias("shard"), "hash", "parts")
    built = staged(workers_ready(dealt).groupBy("shard").applyInArrow(
        _build, "shard long, vocabulary binary, base binary, check binary, final binary, phrases binary"), "collocation-tries")
    out = None
    for lo in range(0, shards, ROUND_TRIES):
        rows = built.filter(F.col("shard").between(lo, lo + ROUND_TRIES - 1)).collect()
        tries = spark.sparkContext.broadcast({r["shard"]: {k: bytes(r[k]) for k in _TYPES} for r in rows})
        found = texts.mapInArrow(_count(tries, shards, depth, go_on), "hash long, word long, n long") \
            .groupBy("hash", "word").agg(F.sum("n").alias("n")).filter(F.col("word").isNull() | (F.col("n") >= least))
        found = staged(found, f"collocation-counts-{depth}")
        tries.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def _next(level: DataFrame, candidates: DataFrame, words: DataFrame, depth: int) -> DataFrame:
    """Candidates one word longer: (hash, lang, phrase, parts)."""
    one = words.select(F.col("word"), F.col("text").alias("last"))
    longer = level.filter(F.col("word").isNotNull()).select("hash", "word").join(candidates, "hash").join(one, "word") \
        .select("lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), F.concat("parts", F.array("word")).alias("parts"))
    return workers_ready(longer).mapInArrow(_hashed, "hash long, lang string, phrase string, parts array<long>")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the hash of each row's parts in front."""
    for batch in batches:
        if batch.num_rows:
            words = batch.column(2).flatten().to_numpy().view(np.uint64)
            depth = len(words) // batch.num_rows
            own = gram_hashes(words, depth)[::depth].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), *batch.columns], ["hash", "lang", "phrase", "parts"])


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = MIN_COUNT, trie: int = TRIE) -> tuple[DataFrame, DataFrame]:
    """(lang, n): all words; and (lang, phrase, size, f): phrases of 1 to ``longest`` words that occur ``least`` times or more."""
    texts = workers_ready(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"))
    words = texts.mapInArrow(_count_words, "lang string, word long, text string, n long") \
        .groupBy("lang", "word", "text").agg(F.sum("n").alias("n")).filter(F.col("text").isNull() | (F.col("n") >= least))
    words = staged(words, "collocation-words")
    totals = words.filter("text is null").select("lang", "n")
    words = words.filter("text is not null")
    candidates = workers_ready(words.select("lang", F.col("text").alias("phrase"), F.array("word").alias("parts"))) \
        .mapInArrow(_hashed, "hash long, lang string, phrase string, parts array<long>")
    counted = []
    for size in range(1, longest + 1):
        candidates = staged(candidates, f"collocation-candidates-{size}")
        level = _level(texts, candidates, size, size < longest, least, trie)
        counted.append(level.filter("word is null").join(candidates, "hash")
                       .select("lang", "phrase", F.lit(size).alias("size"), F.col("n").alias("f")).filter(F.col("f") >= least))
        if size < longest:
            candidates = _next(level, candidates, words, size)
    return totals, staged(reduce(DataFrame.unionByName, counted), "collocation-phrases")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly: a product of 38 digits holds counts up to 10**16."""
    wide = [c.cast("decimal(18,0)") for c in (a, left, right)]
    return F.call_function("div", (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2]).cast("long")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE,
                 trie: int = TRIE) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of every language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is a run of words within a piece of text (pieces end at ``.,;:!?`` and line
    breaks, words at spaces and tabs; A-Z are lower-cased).  Candidates occur ``least`` times
    or more.  Of the cuts into two parts the one of the least score counts (of equal ones, the
    first): ``a`` is the phrase's count, ``l`` and ``r`` those of its parts, ``n`` that of all
    words.  Candidates inside a longer one that has ``inside`` per cent of their count or more
    go.  Ranks are by score, count (both descending) and phrase.

    Defined cases: a null language is ``und``; a null or empty text has no words; repeated rows
    count as often as they are there; an empty table gives no rows; other columns are ignored.
    """
    totals, counts = phrase_counts(docs, longest, least, trie)
    f = counts.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = counts.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k")) \
        .withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")) \
        .withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    best = F.min(F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # sub-phrases of two words or more of every longer candidate
    parts = counts.filter("size > 2").select("lang", "f", words.alias("w"), "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    parts = parts.select("lang", "f", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i")) \
        .groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = scored.join(parts, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of a language's parts first, so that no task sorts all of a language
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
