"""Weak supervision of document quality.

Every rule votes that a document is good or bad, or abstains.  How often each rule
votes what on good and on bad documents is estimated by expectation-maximisation
over the votes of all documents, with the document's quality as the hidden class;
the posterior probability of good quality decides, not a chain of must-pass rules.

The estimate needs only how many documents have each combination of votes: with R
rules at most 3**R rows reach the driver, however many documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged, workers_ready
from corpusflow.llm.textblocks import Words, blocks, gram_hashes, mix, row_of

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper",
         "n_shouts", "n_bare_words", "n_long_words"]
#: Name, what it is taken of (a share of two counts, or a mean), and the bounds: a value in the
#: first range votes good, in the second bad, in neither abstains.
RULES: dict[str, tuple[str, str, tuple[float, float], tuple[float, float]]] = {
    "word_length": ("word_chars", "n_words", (3.0, 9.0), (11.0, float("inf"))),
    "symbols": ("n_symbols", "n_words", (0.0, 0.02), (0.1, float("inf"))),
    "repeated_lines": ("n_dup_lines", "n_lines", (0.0, 0.1), (0.5, float("inf"))),
    "repeated_words": ("n_repeat_words", "n_words", (0.0, 0.1), (0.25, float("inf"))),
    "upper_case": ("n_upper", "n_letters", (0.0, 0.15), (0.4, float("inf"))),
    "shouting": ("n_shouts", "n_words", (0.0, 0.05), (0.25, float("inf"))),
    "bare_marks": ("n_bare_words", "n_words", (0.0, 0.05), (0.2, float("inf"))),
    "letters": ("n_letters", "word_chars", (0.85, 1.0), (-1.0, 0.7)),
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL, _LETTER, _UPPER, _SHOUT = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0xC0:] = True  # the first byte of a longer code point counts as a letter
_SHOUT[list(b"!?")] = True
_LINE_SPACE = " \t\n\r\v\f"


def _per_text(flags: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[words.text_at[1:]] - total[words.text_at[:-1]]


def _repeated_words(words: Words) -> np.ndarray:
    """Words in 3-word windows that occur twice or more in their text, the first included."""
    n = len(words.first) - 1
    if len(words) < 3:
        return np.zeros(n, np.int64)
    text = row_of(words.first)
    grams = gram_hashes(words.hashes(), 3)
    inside = text[:-2] == text[2:]
    key = mix(grams + mix(text[:-2].astype(np.uint64)))
    at = np.flatnonzero(inside)
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key) + 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = again.copy()
    covered[1:] |= again[:-1]
    covered[2:] |= again[:-2]
    return np.bincount(text[covered[:len(text)]], minlength=n).astype(np.int64)


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    own = [line for line in text.split("\n") if line.strip(_LINE_SPACE)]
    return len(own), len(own) - len(set(own))


def block_stats(words: Words, texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of STATS for each text of a block."""
    data, n = words.data, np.diff(words.first)
    starts = (data & 0xC0) != 0x80
    edge = np.zeros(len(data) + 1, np.int8)
    edge[words.start] += 1
    edge[words.end] -= 1
    solid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data] | ((data >= 0x30) & (data <= 0x39)))])
    bare = letters[words.end] == letters[words.start]
    shouts = _SHOUT[data]
    shouts[1:] &= _SHOUT[data[:-1]]  # a mark after a mark
    shouts[:1] = False
    lines = [_lines(t or "") for t in texts]
    rows = len(n)
    text = row_of(words.first)
    return {
        "n_words": n, "word_chars": _per_text(solid & starts, words), "n_symbols": _per_text(_SYMBOL[data], words),
        "n_dup_lines": np.array([x[1] for x in lines], np.int64), "n_repeat_words": _repeated_words(words),
        "n_lines": np.array([x[0] for x in lines], np.int64), "n_letters": _per_text(_LETTER[data], words),
        "n_upper": _per_text(_UPPER[data], words), "n_shouts": _per_text(shouts, words),
        "n_bare_words": np.bincount(text[bare], minlength=rows).astype(np.int64),
        "n_long_words": np.bincount(text[words.end - words.start > 40], minlength=rows).astype(np.int64)}


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """One number per document: base 3 digits, a digit per rule in order (0 abstains, 1 good, 2 bad)."""
    code = np.zeros(len(stats["n_words"]), np.int64)
    for of, per, good, bad in reversed(RULES.values()):
        value = stats[of] / np.maximum(stats[per], 1)
        digit = np.where((value >= good[0]) & (value <= good[1]), 1, np.where((value >= bad[0]) & (value <= bad[1]), 2, 0))
        code = code * 3 + np.where(stats["n_words"] > 0, digit, 0)
    return code


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Too short, or mostly repeated words."""
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def posteriors(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray, float]:
    """P(good) of each combination of votes, each rule's rates, and the share of good documents.

    Rates: [rule, class (good, bad), vote (good, bad)] among the votes cast (to abstain
    says nothing of the class), maximum a posteriori with a beta prior that says
    which class is the good one: there a bad vote is rare.
    """
    if not counts:
        return {}, np.zeros((len(RULES), 2, 2)), 0.8
    codes = np.array(sorted(counts), np.int64)
    n = np.array([counts[c] for c in codes.tolist()], float)
    digit = codes[:, None] // 3 ** np.arange(len(RULES)) % 3
    one = np.eye(3)[digit][:, :, 1:]  # code, rule, vote; all 0 for a rule that abstains
    weight = 0.02 * n.sum() / len(RULES) + 2
    prior = weight * np.array([[0.99, 0.01], [0.60, 0.40]])
    rate = np.broadcast_to(prior / prior.sum(1, keepdims=True), (len(RULES), 2, 2)).copy()
    share = 0.8
    for _ in range(rounds):
        log = np.einsum("crv,rkv->ck", one, np.log(rate)) + np.log([share, 1 - share])
        p = np.exp(log - log.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        rate = np.einsum("c,ck,crv->rkv", n, p, one) + prior
        rate /= rate.sum(2, keepdims=True)
        new = float((n * p[:, 0]).sum() + 8) / (n.sum() + 10)
        if abs(new - share) < 1e-9:
            break
        share = new
    return dict(zip(codes.tolist(), p[:, 0].tolist(), strict=True)), rate, share


def _scored(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi, words in blocks(batch.column(1)):
                stats = block_stats(words, texts[lo:hi])
                columns = [batch.column(0).slice(lo, hi - lo)] if keep else []
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(stats[s].astype(np.int64)) for s in STATS]
                    + [pa.array(base_failed(stats)), pa.array(votes(stats))],
                    ["doc_id"][:keep] + [*STATS, "base_failed", "votes"])
    return run


_STATS_SCHEMA = ", ".join(f"{s} long" for s in STATS) + ", base_failed boolean, votes long"


def _counts(scored: DataFrame) -> dict[int, int]:
    """Documents per combination of votes: at most 3**len(RULES) rows."""
    return {r["votes"]: r["count"] for r in scored.filter("n_words > 0").groupBy("votes").count().collect()}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the counts of STATS, ``base_failed, p_good, kept``.

    ``kept`` is false if the base rules fail, else whether P(good) is at least a half.

    Defined cases: a null or empty text has no words and is not kept; rows with a
    null id and repeated rows are judged like any others; an empty table gives no
    rows; other columns are ignored.
    """
    docs = workers_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = staged(docs.mapInArrow(_scored(True), f"doc_id long, {_STATS_SCHEMA}"), "quality")
    spark = docs.sparkSession
    p, _, _ = posteriors(_counts(scored))
    table = spark.createDataFrame(list(p.items()) or [(-1, 0.0)], "votes long, p_good double")
    return scored.join(F.broadcast(table), "votes", "left").select(  # at most 3**len(RULES) rows
        "doc_id", *STATS, "base_failed", F.coalesce("p_good", F.lit(0.0)).alias("p_good"),
        (~F.col("base_failed") & (F.coalesce("p_good", F.lit(0.0)) >= 0.5)).alias("kept"))


def _filter(p: dict[int, float], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_at)
            texts, good = column.to_pylist(), np.zeros(batch.num_rows, bool)
            for lo, hi, words in blocks(column):
                stats = block_stats(words, texts[lo:hi])
                good[lo:hi] = ~base_failed(stats) & (np.array([p.get(v, 0.0) for v in votes(stats).tolist()]) >= 0.5)
            yield batch.filter(pa.array(good))
    return run


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns; nothing is shuffled but vote counts."""
    docs = workers_ready(docs)
    only = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    p, _, _ = posteriors(_counts(only.mapInArrow(_scored(False), _STATS_SCHEMA)))
    return docs.mapInArrow(_filter(p, docs.columns.index(text_col)), docs.schema)
