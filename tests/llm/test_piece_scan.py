import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from corpusflow.llm import piece_scan as ps
from corpusflow.llm.piece_scan import MARK, Lattice, encode, max_plus, plain, prepared, trace_states

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return Lattice.load(PATH)


def _texts(n, seed=1):
    rnd = random.Random(seed)
    parts = ["the", "and", " ", "  ", "    ", "tionouer", "é", "日本", "\n", "\t", "x" * 9, "----------------", "0xFF", "\x00", "\U0001F600", "ñandú", "ing", "."]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(n)]


def _every_score(lattice, text):
    """Scores of all segmentations."""
    if not text:
        yield 0
    for end in range(1, min(lattice.reach, len(text)) + 1):
        known = lattice.pieces.get(text[:end])
        if known is not None or end == 1:
            for rest in _every_score(lattice, text[end:]):
                yield (known[1] if known is not None else lattice.unknown) + rest


def test_against_all_segmentations(lattice):
    rnd = random.Random(8)
    for _ in range(200):
        text = prepared("".join(rnd.choice(["th", "e", " ", "ing", "é", "日", "\n", "--", "a", "nd"]) for _ in range(rnd.randrange(1, 8))))
        cuts, score = lattice.path(text)
        pieces = [text[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        assert "".join(pieces) == text
        assert score == sum(lattice.pieces[p][1] if p in lattice.pieces else lattice.unknown for p in pieces) == max(_every_score(lattice, text))
        assert lattice.encode(text)[1] == score


def test_numbers_are_the_models(lattice):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in _texts(200, seed=3):
        ids = np.frombuffer(lattice.encode(prepared(text))[0], "<u4").tolist()
        assert model.decode(ids) == text


def test_round_trip(lattice):
    for text in _texts(300, seed=2):
        assert plain(lattice.decode(lattice.encode(prepared(text))[0])) == text


def _toy(seed):
    rnd = random.Random(seed)
    pieces = {c: (300 + i, -rnd.randrange(10 ** 9)) for i, c in enumerate("abc" + ps.MARK)}
    while len(pieces) < 40:
        body = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5)))
        pieces.setdefault(rnd.choice(["", ps.MARK]) + body, (400 + len(pieces), -rnd.randrange(10 ** 9)))
    return Lattice(pieces, 0), rnd


@pytest.mark.parametrize("seed", range(25))
def test_the_scan_finds_the_whole_texts_best_path(seed):
    lattice, rnd = _toy(seed)
    marks = rnd.choice(["", ps.MARK, ps.MARK * 2])
    text = "".join(rnd.choice("abcabcabcd" + marks) for _ in range(rnd.randrange(1, 90)))
    size = rnd.choice([1, 2, 3, 7, 20])
    parts = [text[at:at + size + lattice.reach - 1] for at in range(0, len(text), size)]
    matrices = [lattice.matrix(p, min(size, len(text) - i * size)) for i, p in enumerate(parts)]
    total = matrices[0]
    for m in matrices[1:]:
        total = max_plus(total, m)
    ids, score = lattice.encode(text)
    assert total[0, 0] == score
    half = len(matrices) // 2 or 1
    if len(matrices) > 2:  # associative
        left, right = matrices[0], matrices[half]
        for m in matrices[1:half]:
            left = max_plus(left, m)
        for m in matrices[half + 1:]:
            right = max_plus(right, m)
        assert max_plus(left, right)[0, 0] == score
    states = trace_states(matrices, 0, 0)
    out = [lattice.encode(p[a:min(size, len(text) - i * size) + b]) if a <= min(size, len(text) - i * size) + b else (b"", 0)
           for i, (p, (a, b)) in enumerate(zip(parts, states, strict=True))]
    assert sum(s for _, s in out) == score  # the ids may be another of equally good segmentations
    assert lattice.decode(b"".join(i for i, _ in out)) == lattice.decode(ids) == text


def test_chunks_of_giant_documents(spark, lattice, monkeypatch):
    for name, value in (("GIANT", 300), ("CHUNK", 100), ("BLOCK", 3)):
        monkeypatch.setattr(ps, name, value)
    rnd = random.Random(4)
    docs = [(0, None), (1, ""), (2, " "), (3, "a" * 2000), (4, "xyz日" * 300), (5, "word " * 500)] \
        + [(i, "".join(_texts(40, seed=i))) for i in range(10, 30)]
    rnd.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = encode(df, PATH).orderBy("doc_id", "chunk").collect()
    for d, text in docs:
        own = [r for r in rows if r.doc_id == d]
        assert "".join(r.text for r in own) == (text or "")
        assert [r.chunk for r in own] == list(range(len(own)))
        assert len(own) == (1 if len(text or "") <= 300 else -(-len(prepared(text)) // 100))
        assert sum(r.score for r in own) == lattice.encode(prepared(text))[1]
        assert all(r.n_ids * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in own)


def test_edges_of_the_input(spark):
    schema = "row string, doc_id long, text string, chunk string"
    assert encode(spark.createDataFrame([], schema), PATH).collect() == []
    long = "ab cd " * 40_000
    df = spark.createDataFrame([("x", 1, long, "y"), ("x", 1, long, "y"), (None, None, long, None)], schema)
    rows = encode(df, PATH).collect()
    assert len(rows) == 3 * -(-(len(long) + 1) // ps.CHUNK)
    assert sum(len(r.text) for r in rows) == 3 * len(long)


def test_words_segmented_together_are_as_one_by_one():
    pieces = {p: (i, -s) for i, (p, s) in enumerate([("a", 5), ("b", 6), ("ab", 7), ("ba", 7), ("aba", 9), (MARK, 4), (MARK + "a", 6), ("é", 5), ("bab", 12), ("aab", 10)])}
    own = Lattice(pieces, 100)
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aabbé" + MARK + "x日") for _ in range(rnd.randrange(12))) for _ in range(3_000)]
    words += ["ab" * 200, "a" * 256, "a" * 257, "é" * 1000, "", "x", "😀a"]
    assert own.numbers_many(words) == [own._numbers(w) for w in words]


def test_matrices_of_many_chunks_are_those_of_each(lattice):
    rnd = random.Random(5)
    texts = [MARK + "".join(rnd.choice(["the", "é", MARK, MARK, "international", "x", "日本"]) for _ in range(rnd.randrange(1, 60))) for _ in range(40)]
    sizes = [max(1, len(t) - rnd.randrange(12)) for t in texts]
    for text, size, found in zip(texts, sizes, lattice.matrices(texts, sizes), strict=True):
        assert (found == lattice.matrix(text, size)).all()
