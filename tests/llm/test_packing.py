import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from corpusflow.llm.packing import _best_fit, local_search, pack, pack_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def _whole(rows, texts, model, size):
    """Check that the rows are the documents' ids, cut and placed as asked."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {d for d, _ in texts}
    for d, text in texts:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[d], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // size)))
        for r in own:
            part = ids[r.piece * size:(r.piece + 1) * size]
            assert (r.start, r.length) == (r.piece * size, len(part))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_seq)


def test_pieces_and_places(spark, model):
    rnd = random.Random(1)
    odd = ["Ab.", "e.g.", "...", "a,.", "x’s don't I'll", "É.", "é.", "J̌", "…", "…,", "İstanbul ΑΣ.", " a b\x1cc",
           "<|endoftext|>", "A<|startoftext|>.", "<|STARTOFTEXT|>", "1234,5", "日本語.", "‍", "\U0001F600!!", "a\x00b", "<b>.", "--", "%%%", "a|b"]
    texts = [(1, None), (2, ""), (3, " \n "), (4, "word " * 9000), (5, "x" * 5000)]
    texts += [(i, rnd.choice([" ", "\n", "\t", ""]).join(rnd.choice(odd) for _ in range(rnd.randrange(40)))) for i in range(10, 400)]
    rows = pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), PATH, size=512).collect()
    total = sum(r.length for r in rows)
    assert _whole(rows, texts, model, 512) == -(-total // 512)


def test_documents_of_the_given_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = pack(docs, PATH).collect()
    assert _whole(rows, texts, model, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_several_groups(spark, model, monkeypatch):
    import corpusflow.llm.packing as m
    monkeypatch.setattr(m, "GROUP", 50)
    rnd = random.Random(2)
    texts = [(i, "a " * rnd.randrange(1, 120)) for i in range(700)]
    rows = pack(spark.createDataFrame(texts, "doc_id long, text string"), PATH, size=128, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    n = _whole(rows, texts, model, 128)
    assert n <= 1.07 * sum(r.length for r in rows) / 128


def test_local_search_gains():
    rnd = np.random.default_rng(4)
    fewer = 0
    for _ in range(30):
        length = rnd.integers(20, 70, rnd.integers(2, 200))
        place, fill = _best_fit(length, 100)
        before, squares = int((fill > 0).sum()), int((fill ** 2).sum())
        local_search(length, place, fill, 100)
        assert (np.bincount(place, weights=length, minlength=len(fill)) == fill).all()
        assert fill.max() <= 100 and int((fill ** 2).sum()) >= squares
        fewer += before - int((fill > 0).sum())
    assert fewer > 0


def test_swaps_empty_a_sequence():
    length = np.array([6, 4, 5, 3, 2])  # 20 = 2 x 10, but placed over three
    place, fill = np.array([0, 1, 1, 2, 2]), np.array([6, 9, 5])
    local_search(length, place, fill, 10)
    assert (fill > 0).sum() == 2


def test_pack_lengths_of_equal_and_full_pieces():
    assert len(set(pack_lengths(np.full(10, 100), 100))) == 10
    assert len(set(pack_lengths(np.full(1000, 1), 100))) == 10
    assert len(pack_lengths(np.zeros(0, np.int64), 100)) == 0


def test_edges_of_the_input(spark):
    schema = "doc_id long, text string, bin long, length string"
    assert pack(spark.createDataFrame([], schema), PATH).collect() == []
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 1, "x"), (None, "b", None, None)], schema)
    rows = pack(df, PATH).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_rows_without_ids_are_dealt_out(spark, monkeypatch):
    import corpusflow.llm.packing as m
    monkeypatch.setattr(m, "GROUP", 50)
    df = spark.createDataFrame([(None if i % 3 else 7, "a b c") for i in range(600)], "doc_id long, text string").repartition(4)
    rows = pack(df, PATH, size=64).collect()
    assert len(rows) == 600 and len({(r.sequence_id, r.offset) for r in rows}) == 600
    groups = {r.sequence_id // (m.GROUP * 2) for r in rows if r.sequence_id >= 0}
    assert len(groups) > 6  # twelve groups of about fifty rows
