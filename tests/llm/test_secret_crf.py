import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import secret_crf as sc
from corpusflow.llm.secret_crf import Field, base_spans, block_spans, fit, made_up_lines, redact, scan
from corpusflow.llm.textblocks import blocks

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return ",".join(f"{sc.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


@pytest.fixture(scope="module")
def field(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def _odd_texts(n):
    rnd = random.Random(6)
    parts = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdefgh", "x1/+_.-=", "é", "ſecret", "toKen",
             "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef" * 2, "deadbeef", "\n", "日本", "  ", "tokentoken=12345678", "\t"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(25))) for _ in range(n)]


def test_base_spans_stay(spark, field):
    docs = list(enumerate([None, "", " ", *_odd_texts(400), "password = " + "a" * 1_500_000, "f" * 2_000_000]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in scan(df, field).collect()}
    assert len(rows) == len(docs)
    for d, text in docs:
        assert rows[d].base == base(text)
        own = rows[d].spans.split(",") if rows[d].spans else []
        assert [s for s in own if not s.startswith("model")] == (rows[d].base.split(",") if rows[d].base else [])
        place = [(int(a), sc.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in own)]
        assert place == sorted(place) and all(0 <= a < b <= len(text) for a, _, b in place)


def test_held_out_accuracy(field):
    lines = made_up_lines(500, seed=12345)
    found = missed = wrong = 0
    for lo, _, words in blocks(pa.array([t for t, _ in lines])):
        for i, (_, spans) in enumerate(block_spans(field, words), lo):
            want = lines[i][1]
            if not want:
                wrong += bool(spans)
            elif any(a <= want[0][0] and b >= want[0][1] - 2 for a, _, b in spans):
                found += 1
            else:
                missed += 1
    assert found / (found + missed) > 0.93
    assert wrong / (len(lines) - found - missed) < 0.12


def test_the_field_adds_to_the_patterns_and_leaves_prose_alone(spark, field):
    text = "the passphrase is Zx9Qw2Lk8Tr4Vb7Nm1Ps in that note"
    assert base(text) == ""
    (_, every), = block_spans(field, next(blocks(pa.array([text])))[2])
    assert [text[a:b] for a, _, b in every] == ["Zx9Qw2Lk8Tr4Vb7Nm1Ps"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = docs.filter("not rlike(text, '(?i)token|AKIA|[0-9a-f]{32}')")
    assert scan(clean, field).filter("spans <> ''").count() <= 0.002 * clean.count()


def test_decoding_finds_the_best_path():
    rnd = np.random.default_rng(2)
    for _ in range(60):
        field = Field(np.zeros((1, 3)), rnd.normal(size=(3, 3)), rnd.normal(size=3))
        scores = rnd.normal(size=(7, 3)) * 3
        scores[rnd.random(7) < 0.4, 0] += rnd.choice([5, 40])
        begins = np.zeros(7, bool)
        begins[[0, rnd.integers(1, 7)]] = True

        def total(path, scores=scores, begins=begins, field=field):
            return sum(scores[t, k] + (field.first[k] if begins[t] else field.pair[path[t - 1], k]) for t, k in enumerate(path))

        best = max(itertools.product(range(3), repeat=7), key=total)
        assert abs(total(tuple(field.decode(scores, begins).tolist())) - total(best)) < 1e-9


def test_pieces_of_a_block_do_not_matter(field):
    texts = _odd_texts(200) + [t for t, _ in made_up_lines(200, seed=3)]
    whole = [x for _, _, w in blocks(pa.array(texts)) for x in block_spans(field, w)]
    single = [x for t in texts for _, _, w in blocks(pa.array([t])) for x in block_spans(field, w)]
    assert whole == single


def test_redaction(spark, field):
    schema = "text string, n_chars int, doc_id long, spans string"
    rows = [('a token = "0123456789abcdef0123456789abcdef" é', 45, 1, "x"), (None, None, None, None), ("", 0, 2, "y"), ("plain", 5, 3, "z")]
    got = redact(spark.createDataFrame(rows, schema), field)
    assert got.columns == ["text", "n_chars", "doc_id", "spans"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [('a [secret]" é', 13, 1, "x"), (None, None, None, None), ("", 0, 2, "y"), ("plain", 5, 3, "z")], key=str)


def test_edges_of_the_input(spark, field):
    schema = "doc_id long, text string, spans string, base long"
    assert scan(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "secret: 12345678", "x", 1), (1, "secret: 12345678", "x", 1), (None, None, None, None)]
    got = sorted(((r.doc_id, r.n_assign, r.base) for r in scan(spark.createDataFrame(rows, schema), field).collect()), key=str)
    assert got == sorted([(1, 1, "assign:0:16"), (1, 1, "assign:0:16"), (None, 0, "")], key=str)
    assert base_spans(b"") == []
