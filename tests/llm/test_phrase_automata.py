import random
from collections import Counter

import pyarrow as pa
import pytest

from corpusflow.llm.phrase_automata import locate, sha256_hex, substring_dedup
from tests.llm.brute import substring_dedup as brute


def _texts(seed: int, width: int) -> list[tuple[int, str | None]]:
    rnd = random.Random(seed)
    phrases = [[f"p{j}_{i}" for i in range(rnd.choice([width - 1, width, width + 1, 3 * width]))] for j in range(8)]
    out: list[tuple[int, str | None]] = [(900, None), (901, ""), (902, "short"), (903, "a " * 60), (904, "a\n" * 3 * width)]
    for d in rnd.sample(range(800), 150):
        own: list[str] = []
        for _ in range(rnd.randrange(6)):
            own += rnd.choice(phrases) if rnd.random() < 0.5 else [f"u{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(30))]
            if own and rnd.random() < 0.2:
                del own[:rnd.randrange(len(own))]
        out.append((d, rnd.choice([" ", "\n", " \t"]).join(own)))
    return out


def _run(spark, docs, width, gram):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return {r.doc_id: (r.n_words, r.n_removed, sha256_hex(bytes(r.kept))) for r in substring_dedup(df, width, gram).collect()}


@pytest.mark.parametrize(("width", "gram"), [(20, 4), (5, 2), (7, 7), (1, 1)])
def test_against_brute_force(spark, width, gram):
    docs = _texts(width, max(width, 2))
    assert _run(spark, docs, width, gram) == brute(docs, width)


def test_hot_anchors_are_dealt_out(spark, monkeypatch):
    import corpusflow.llm.phrase_automata as m
    monkeypatch.setattr(m, "SLICE_BYTES", 300)
    docs = [(i, f"h{i} " + " ".join(f"s{j}" for j in range(25)) + f" t{i} t{i % 3}") for i in range(80)]
    assert _run(spark, docs, 20, 4) == brute(docs, 20)


def test_locate_overlapping_windows():
    rows = [(0, 1, 1, 0, "a b a b a b a b"), (0, 1, 2, 0, "b a b a c")]
    assert sorted(locate(rows, 3)) == [(1, 2, 6), (2, 0, 4)]


def test_edges_of_the_input(spark):
    schema = "doc_id long, text string, first long, key string"
    assert substring_dedup(spark.createDataFrame([], schema)).collect() == []
    own = " ".join(f"w{i}" for i in range(30))
    rows = [(1, own, 1, "k"), (1, own, 1, "k"), (None, own, 2, None), (3, own, 3, None), (4, None, None, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, 30, 0), (1, 30, 0), (None, 30, 0), (3, 30, 30), (4, 0, 0)], key=str)


def test_a_very_long_text(spark):
    rnd = random.Random(3)
    long = " ".join(f"u{rnd.randrange(10 ** 7)}" for _ in range(700_000))
    half = " ".join(long.split()[300_000:300_050])
    docs = [(1, long), (2, "x " + half + " y"), (3, "z" * 3_000_000)]
    assert _run(spark, docs, 20, 4) == brute(docs, 20)


def test_no_slice_needs_all_spans_of_a_hot_anchor(spark, monkeypatch):
    import corpusflow.llm.phrase_automata as m
    monkeypatch.setattr(m, "SLICE_BYTES", 10_000)
    n = 1_500
    spans = spark.createDataFrame([(i, 0, f"h{i} " + " ".join(f"s{j}" for j in range(25)) + f" t{i}") for i in range(n)], "doc_id long, first int, words string")
    sizes = Counter()
    slices = m._slices
    monkeypatch.setattr(m, "_slices", lambda width: lambda batches: (pa.RecordBatch.from_arrays(
        [b.column(0), pa.array([0] * b.num_rows, pa.int32()), pa.array([int(x is not None) for x in b.column(3).to_pylist()], pa.int32())], ["doc_id", "first", "size"])
        for b in batches))
    for r in m._located(spans, 20).groupBy("doc_id").sum("size").collect():
        sizes[r[0]] += r[1]
    assert len(sizes) > 10 and sum(sizes.values()) == n and max(sizes.values()) < 3 * n / len(sizes)
    monkeypatch.setattr(m, "_slices", slices)
    found = {(r.doc_id, r.first, r.size) for r in m._located(spans, 20).collect()}
    assert found == {(i, 1, 25) for i in range(1, n)}


@pytest.mark.parametrize("width", [20, 5])
def test_hot_anchors_in_slices(spark, monkeypatch, width):
    import corpusflow.llm.phrase_automata as m
    monkeypatch.setattr(m, "SLICE_BYTES", 200)
    docs = _texts(width + 1, width)
    docs += [(1000 + i, f"h{i} " + " ".join(f"s{j}" for j in range(25)) + f" t{i} t{i % 3}") for i in range(60)]
    docs.append(docs[-1])  # a repeated row is no later place
    want = brute(docs[:-1], width)
    assert _run(spark, docs, width, min(width, 4)) == want
