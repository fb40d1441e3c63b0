import hashlib
import random

import pytest

from corpusflow.llm.order_minhash import order_minhash


def _edited(docs):
    line = sorted(docs, key=lambda x: (-x[0], x[1] or ""))
    out = {}
    for i, (d, t) in enumerate(line):
        t, after = t or "", line[(i + 1) % len(line)][1] or ""
        k = len(t) // 3
        out[d] = (len(t), t[:len(t) - k] + after[:k], line[(i + 1) % len(line)][0])
    return out


def _texts(seed, n=80):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本", "\U0001F600", "x" * 30]
    out = [(1000, None), (1001, ""), (1002, "a"), (-5, " \n"), (2 ** 40, "one two"), (2 ** 40 + 1, "one two")]
    for i in rnd.sample(range(900), n):
        own = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 5, 40, 200, 600]))]
        out.append((i, rnd.choice([" ", "\n", "\t "]).join(own)))
    return out


def test_edited_texts_and_next_documents(spark, monkeypatch):
    import corpusflow.llm.order_minhash as m
    monkeypatch.setattr(m, "BUCKET_BYTES", 3_000)
    docs = _texts(1)
    rows = {r.doc_id: r for r in order_minhash(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    want = _edited(docs)
    assert set(rows) == set(want)
    plain = {r.doc_id: r.fingerprint for r in order_minhash(spark.createDataFrame(
        [(d, e) for d, (_, e, _) in want.items()], "doc_id long, text string")).collect()}
    for d, (n, edited, after) in want.items():
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.edited_fingerprint == plain[d]  # the edited text's own fingerprint
        a, b, c = ({p.split(":")[0]: p for p in f.split()} for f in (r.fingerprint, r.edited_fingerprint, rows[after].fingerprint))
        for got, other in ((r.near_edited, b), (r.near_next, c)):
            assert got == (len(set(a.values()) & set(other.values())) / len(a.keys() | other.keys()) if a or other else 1.0)


def test_order_matters_and_occurrences_count(spark):
    rnd = random.Random(2)
    own = [f"u{i}" for i in range(300)]
    blocks = [own[i:i + 10] for i in range(0, 300, 10)]
    rnd.shuffle(blocks)
    moved = " ".join(w for b in blocks for w in b)
    few = own[:100] + ["new"] + own[101:]
    docs = {5: " ".join(own), 4: " ".join(few), 3: " ".join(own), 2: moved, 1: "again " * 50, 0: "again " * 500}
    rows = {r.doc_id: r for r in order_minhash(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert rows[5].fingerprint == rows[3].fingerprint
    assert rows[5].near_next > 0.9 and rows[4].near_next > 0.9
    assert rows[3].near_next < 0.7  # the same words in another order
    assert rows[1].near_next < 0.5  # the same few k-mers, but other numbers of them
    assert rows[2].near_next == 0


@pytest.mark.parametrize("rows", [[], [(3, "only one text here", 1, "x")]])
def test_none_or_one(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, rn long, next string")
    got = order_minhash(df).collect()
    assert len(got) == len(rows)
    assert all(r.near_next == 1.0 for r in got)


def test_edges_of_the_input(spark):
    rows = [(1, "a b c d e f", 1, "x"), (1, "a b c d e f", 1, "x"), (None, "a b", None, None), (2, None, 2, "y"), (3, "z" * 3_000_000, 3, "z")]
    got = order_minhash(spark.createDataFrame(rows, "doc_id long, text string, rn long, next string")).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == [(1, 11), (1, 11), (2, 0), (3, 3_000_000)]
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1


def test_no_python_on_the_main_path(spark):
    plan = order_minhash(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))


def test_one_insertion_in_a_text_without_spaces(spark):
    rnd = random.Random(6)

    def of(alphabet, n=4_000):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    code = "".join(f"function {c}(a,{c}){{return a[{i}]+{c}*{i * 7}}};".replace(" ", "_") for i, c in enumerate(of("abcxyz", 200)))
    texts = {"han": of([chr(x) for x in range(0x4E00, 0x9FA5)]), "rare han": of([chr(x) for x in range(0x20000, 0x2A000)]),
             "kana": of([chr(x) for x in range(0x3042, 0x3094)]), "thai": of([chr(x) for x in range(0x0E01, 0x0E2F)]),
             "base64": of(base64), "hex": of("0123456789abcdef"), "digits": of("0123456789"), "code": code,
             "cyrillic": of([chr(x) for x in range(0x430, 0x450)]), "one": "z" * 4_000}
    docs = []
    for i, text in enumerate(texts.values()):
        half = len(text) // 2
        for j, x in enumerate((text, "a" + text, text, text[:half] + "a" + text[half:])):
            docs.append((i * 10 + 9 - j, x))
    rows = {r.doc_id: r for r in order_minhash(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, name in enumerate(texts):
        assert rows[i * 10 + 9].near_next > 0.8, name  # one put in front
        if name != "one":  # that has few symbols
            assert rows[i * 10 + 7].near_next > 0.8, name  # and in the middle


def test_ids_further_apart_than_a_long(spark):
    ids = [-(2 ** 63), -(2 ** 63 - 1), -7, 5, 6, 2 ** 63 - 1]
    docs = [(d, f"text number {i} of these few, with some more words") for i, d in enumerate(ids)]
    rows = {r.doc_id: r for r in order_minhash(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sorted(rows) == ids
    text = dict(docs)
    for i, d in enumerate(ids):
        own, following = text[d], text[ids[i - 1]]
        third = len(own) // 3
        assert rows[d].edited_sha256 == hashlib.sha256((own[:len(own) - third] + following[:third]).encode()).hexdigest()
