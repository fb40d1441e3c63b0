import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from corpusflow.llm import collocations as co
from corpusflow.llm.collocations import Trie, collocations, double_array
from corpusflow.llm.queries_phrases import op11_phrase_collocations

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, longest=3, least=10, top=2000, inside=50):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        rows = []
        for p, a in found.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, _, left, right = min((floor(Fraction(10 ** 6 * a * a, own[p[:k]] * own[p[k:]])), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def _found(df, **more):
    got = collocations(df, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def _texts(n, seed):
    rnd = random.Random(seed)
    words = ["The", "the", "cat", "CAT", "é", "É", "日本", "x-y", "sat", "on", "a", "mat", "zz q", " ", "of"]
    return [(None if rnd.random() < 0.03 else "".join(
        rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! ", "\x0b"]) for _ in range(rnd.randrange(40))),
        rnd.choice(["en", "en", "de", None, "und", ""])) for _ in range(n)]


@pytest.mark.parametrize(("depth", "n", "words"), [(1, 50, 60), (2, 400, 30), (3, 3000, 25), (2, 3, 2), (3, 1, 1)])
def test_double_array_accepts_its_paths_and_no_others(depth, n, words):
    rnd = np.random.default_rng(n)
    vocabulary = np.unique(rnd.integers(0, 2 ** 63, words).astype(np.uint64))
    rows = np.unique(rnd.integers(0, len(vocabulary), (n, depth)), axis=0)
    trie = Trie.of(vocabulary[rows], np.arange(len(rows), dtype=np.uint64))
    text = np.r_[rnd.choice(vocabulary, 5000), rnd.integers(0, 2 ** 63, 50).astype(np.uint64), rnd.choice(vocabulary, 50)]
    at, state = trie.advance(text, np.arange(len(text) - depth + 1), depth)
    known = {tuple(vocabulary[r].tolist()): i for i, r in enumerate(rows)}
    name = dict(zip(trie.final.tolist(), trie.phrases.tolist(), strict=True))
    assert len(name) == len(rows)
    want = {i: known[w] for i in range(len(text) - depth + 1) if (w := tuple(text[i:i + depth].tolist())) in known}
    assert {int(a): name[int(s)] for a, s in zip(at, state, strict=True)} == want


def test_one_hot_parent():
    paths = np.array([[1, c] for c in range(1, 20001)] + [[c, 1] for c in range(2, 20001)])
    base, check, final = double_array(paths)
    assert len(set(final.tolist())) == len(paths) and len(check) < 4 * len(paths)
    assert all(check[f] >= 0 for f in final[:100])


def test_against_brute_force(spark):
    rows = _texts(600, 1)
    rows += [("a long one " * 20000, "en"), (None, None), ("", ""), ("w" * 1_000_000 + " end", "de"), rows[5], rows[5]]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(6)
    want = brute(rows)
    assert want and {r[0] for r in want} > {"und", "en", ""}
    assert _found(df) == want


def test_many_tries_many_rounds_and_cuts_of_the_list(spark, monkeypatch):
    rows = _texts(300, 2)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    want = brute(rows, least=4, top=7)
    assert _found(df, least=4, top=7) == want
    assert _found(df, least=4, top=7, trie=5) == want
    monkeypatch.setattr(co, "ROUND_TRIES", 3)
    assert _found(df, least=4, top=7, trie=5) == want


def test_longer_phrases(spark):
    rows = _texts(200, 3)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert _found(df, longest=4, least=3, inside=80) == brute(rows, longest=4, least=3, inside=80)


def test_products_beyond_64_bits(spark):
    n = 5_000_000_000_000
    df = spark.createDataFrame([(n, n + 1, n + 2), (10, 10, 10), (n, n, n), (7, 11, 13)], "a long, l long, r long")
    got = [r[0] for r in df.select(co._score(df.a, df.l, df.r)).collect()]
    assert got == [10 ** 6 * a * a // (x * y) for a, x, y in [(n, n + 1, n + 2), (10, 10, 10), (n, n, n), (7, 11, 13)]]


def test_empty_and_odd_tables(spark):
    assert _found(spark.createDataFrame([], SCHEMA)) == []
    assert _found(spark.createDataFrame([(1, None, None), (2, "only once", "en")], SCHEMA)) == []
    other = "word long, n string, text string, hash string, lang string, phrase int, f int"
    df = spark.createDataFrame([(1, "x", "to be or not to be, " * 12, "h", None, 1, 2)], other)
    assert _found(df) == brute([("to be or not to be, " * 12, None)])


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = op11_phrase_collocations(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == brute([(r.text, r.lang) for r in docs])
