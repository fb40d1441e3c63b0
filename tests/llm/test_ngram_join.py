import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm.ngram_join import Threshold, jaccard_join, one_of_each
from tests.llm.brute import jaccard_components


def _texts(seed: int, n: int = 120) -> list[tuple[int, str | None]]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "STRASSE", "ñandú"]
    out: list[tuple[int, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two")]
    base = []
    for i in range(10, 10 + n):
        if base and rnd.random() < 0.6:
            own = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                at = rnd.randrange(len(own))
                own[at:at + rnd.choice([0, 1])] = [rnd.choice(vocabulary)]
        else:
            own = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 8, 12, 30, 80, 200]))]
        base.append(own)
        out.append((i, rnd.choice([" ", "\n", "\t  "]).join(own)))
    return out


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (1, 60)])
def test_against_all_pairs(spark, k, num):
    docs = _texts(k * num)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), k, Threshold(num, 100)).collect()}
    assert got == jaccard_components(docs, k, num, 100)


def test_a_group_in_several_blocks(spark, monkeypatch):
    import corpusflow.llm.ngram_join as m
    monkeypatch.setattr(m, "BLOCK_SETS", 7)
    rnd = random.Random(5)
    base = [f"v{i}" for i in range(90)]
    docs = []
    for i in range(60):
        own = list(base)
        own[rnd.randrange(90)] = f"x{i}"
        docs.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 3, Threshold(90, 100)).collect()}
    assert got == jaccard_components(docs, 3, 90, 100)


def test_edges_of_the_input(spark):
    schema = "doc_id long, text string, n_shingles long, comp string"
    empty = spark.createDataFrame([], schema)
    assert jaccard_join(empty).collect() == []
    rows = [(1, "a b c d e f", 5, "x"), (1, "a b c d e f", 5, "x"), (None, "a b c d e f", None, None), (2, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 0, 2)], key=str)
    assert one_of_each(df).columns == df.columns
    assert one_of_each(df).count() == 4


def test_a_very_long_text(spark):
    long = " ".join(f"u{i % 70_001}" for i in range(400_000))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "x" * 3_000_000)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_common_n_grams_make_no_groups(spark, monkeypatch):
    import corpusflow.llm.ngram_join as m
    rnd = random.Random(11)
    docs = [(i, " ".join(rnd.choice("abcdefghi") for _ in range(40))) for i in range(240)]  # every 3-gram is in about 12 texts
    docs.append((240, docs[0][1] + " z"))
    kept, staged = {}, m.staged
    monkeypatch.setattr(m, "staged", lambda df, label: kept.setdefault(label, staged(df, label)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 3, Threshold(90, 100)).collect()}
    assert got == jaccard_components(docs, 3, 90, 100)
    assert sorted(r.rep for r in kept["join-groups"].collect()) == [0, 240]


@pytest.mark.parametrize(("num", "top"), [(90, 1 << 64), (80, 1 << 64), (60, 1 << 64), (90, 1 << 61), (80, 1 << 60)])
def test_prefixes_of_linked_sets_meet(num, top):
    from corpusflow.llm.ngram_join import segments
    rnd = random.Random(num + top % 7)
    limit, sets = Threshold(num, 100), []
    for n in (9, 10, 11, 13, 19, 20, 40, 41, 150, 151, 700):
        for _ in range(4):
            base = {rnd.randrange(top) for _ in range(n)}  # below a small top, most segments are empty
            sets.append(base)
            for cut in (1, 2, n // 20, n // 10, n // 6):
                sets.append(set(rnd.sample(sorted(base), n - cut // 2)) | {rnd.randrange(top) for _ in range(cut - cut // 2)})
    sets = [s for s in sets if limit.differs(len(s))]
    own = collections.defaultdict(list)
    for segment, of, spare in zip(*segments([np.array(sorted(s), np.uint64) for s in sets], limit), strict=True):
        own[int(of), int(segment) >> 1 & 127].append((int(segment), int(spare)))
    count = collections.Counter(s for rows in own.values() for s, _ in rows)
    prefix = collections.defaultdict(set)
    for (of, _), rows in own.items():
        rows = sorted(rows, key=lambda r: (r[0] & 1, count[r[0]], r[0]))
        prefix[of] |= {s for s, _ in rows[:len(rows) - rows[0][1]]}
    linked = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a != b and 100 * len(a & b) >= num * len(a | b)]
    assert len(linked) > 30
    assert all(prefix[i] & prefix[j] for i, j in linked)


def _batches(rows, names, size):
    columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
    for at in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + size]) for c in columns], names)


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_counts_and_prefixes_across_batches(monkeypatch, size):
    import corpusflow.llm.ngram_join as m
    monkeypatch.setattr(m, "MOST_SETS", 4)
    rnd = random.Random(3)
    rows = sorted([(s, o) for s in range(30) for o in rnd.sample(range(50), rnd.choice([1, 1, 2, 3, 4, 5, 20]))] * 2)
    count = collections.Counter(s for s, _ in set(rows))
    got = [r for b in m._shared(_batches(rows, ["segment", "set"], size)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert got == [(s, o, min(4, count[s])) for s, o in sorted(set(rows)) if count[s] > 1]

    rows = [(s << 8 | like << 1, number << 15 | spare) for number in range(20) for like in (3, 4)
            for spare in [rnd.choice([0, 1, 3])] for s in range(rnd.choice([1, 2, 4, 9]))]
    want, seen = [], collections.Counter()
    for segment, own in rows:
        seen[own, segment >> 1 & 127] += 1
        if seen[own, segment >> 1 & 127] > own & 32767:
            want.append((segment, own >> 15))
    got = [r for b in m._prefixes(_batches(rows, ["segment", "set"], size)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert got == want
