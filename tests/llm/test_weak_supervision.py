import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusflow.llm import weak_supervision as ws
from corpusflow.llm.weak_supervision import RULES, keep_good, posteriors, quality
from tests.llm.brute import words

SF = "/root/testdata/sf0.01"


def base(text):
    own = words(text)
    grams = Counter(zip(own, own[1:], own[2:], strict=False))
    hit = set()
    for i, g in enumerate(zip(own, own[1:], own[2:], strict=False)):
        if grams[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(own) < 50 or 100 * len(hit) > 50 * len(own)
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def _got(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()}


def test_base_counts(spark):
    rnd = random.Random(1)
    parts = ["é", "a", "word", "#*", "a|b", "\n", "\n\n", " \t", "a a a\n", "  a a a\n", "\x0b", " ", "日本", "!!", "x" * 50]
    docs = [(0, None), (1, ""), (2, " \n "), (3, "a b c " * 40), (4, "same\n" * 60), (5, "z" * 2_000_000), (6, "w " * 500_000)]
    docs += [(i, "".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randrange(120)))) for i in range(10, 300)]
    got = _got(quality(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == {d: base(t) for d, t in docs}


def test_quality_of_the_labelled_documents(spark):
    found = quality(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "kept", "base_failed")
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    bad = [r.kept for r in rows if r.quality == 0]
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert np.mean(bad) < 0.05 and np.mean(good) > 0.97


def test_rates_are_found_again():
    """Votes drawn from known rates: the estimate comes near them, and decides nearly as well as the truth."""
    rnd = np.random.default_rng(3)
    n, bad = 20_000, rnd.random(20_000) < 0.2
    said_bad = np.where(bad[:, None], np.linspace(0.3, 0.7, len(RULES)), np.linspace(0.01, 0.05, len(RULES)))
    vote = np.where(rnd.random((n, len(RULES))) < 0.2, 0, np.where(rnd.random((n, len(RULES))) < said_bad, 2, 1))
    code = (vote * 3 ** np.arange(len(RULES))).sum(1)
    p, rate, share = posteriors(dict(Counter(code.tolist())))
    assert abs(share - 0.8) < 0.02
    assert np.abs(rate[:, 0, 1] - np.linspace(0.01, 0.05, len(RULES))).max() < 0.02
    assert np.abs(rate[:, 1, 1] - np.linspace(0.3, 0.7, len(RULES))).max() < 0.06
    assert np.mean((np.array([p[c] for c in code.tolist()]) < 0.5) == bad) > 0.95


def test_one_failed_rule_of_a_good_kind_is_outvoted():
    """A weak rule's lone bad vote does not reject: not all rules must pass."""
    n = len(RULES)
    good, all_bad = sum(3 ** i for i in range(n)), sum(2 * 3 ** i for i in range(n))
    one_bad = good + 3 ** 2
    p, _, _ = posteriors({good: 900, one_bad: 60, all_bad: 100})
    assert p[good] > 0.99 and p[one_bad] > 0.5 and p[all_bad] < 0.01


@pytest.mark.parametrize("empty", [True, False])
def test_edges_of_the_input(spark, empty):
    schema = "votes string, text string, doc_id long, kept boolean, n_words long"
    text = " ".join(f"w{i}" for i in range(80))
    rows = [] if empty else [("x", text, 1, False, 1), ("x", text, 1, False, 1), (None, text, None, None, None), ("y", None, 2, True, 2)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in quality(df).collect()), key=str)
    assert got == sorted([] if empty else [(1, 80, True), (1, 80, True), (None, 80, True), (2, 0, False)], key=str)
    kept = keep_good(df)
    assert kept.schema == df.schema
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows[:3], key=str)


def test_filter_and_table_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in quality(df).filter("kept").collect()}
    assert {r.doc_id for r in keep_good(df).collect()} == kept and kept
    assert len(ws.STATS) == len(set(ws.STATS))
