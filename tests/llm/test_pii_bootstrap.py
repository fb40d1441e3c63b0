import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.llm.pii_bootstrap import KINDS, lexical_patterns, luhn, personal_data
from corpusflow.llm.queries_scans import op13_pii_bootstrap

SCHEMA = "doc_id long, text string"
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def checksum(digits):
    return sum(int(c) if i % 2 == 0 else int("0246813579"[int(c)]) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
            "card": 12 <= len(digits) <= 19 and checksum(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    out = [(m.start(), i, m.end()) for i, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if valid(kind, m[0])]
    return sorted(out)


def said(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _odd_texts(n, seed=3):
    rnd = random.Random(seed)
    parts = ["a.b", "@", "x-y.com", ".", "..", "1", "25", "255", "256", "0007", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 222-3333", "+", "(", ")",
             " ", "  ", "-", "é", "日本", "😀", "\n", "\t", "tel:", "_", "%", "123456789012", "1.2.3.4", "00000000000000000255.1.1.1", "99999999999999999999.1.1.1"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(n)]


def test_base_spans(spark):
    texts = [None, "", " ", *_odd_texts(1500), "a" * 2_000, "9" * 2_000, "a@" * 100_000 + "b.c", "1." * 2_000, "1 " * 300_000, "+1" + "(" * 300_000, "x@y" + ".z" * 100_000,
             "a@b.c_d@e.f mail" * 3000, "1." * 200_000, "a" * 400_000, "9" * 400_000]
    known = {len(texts) - 3: [(8 * i, 1, 8 * i + 7) for i in range(50_000)], len(texts) - 2: [], len(texts) - 1: []}  # the plain patterns take too long
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in personal_data(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        want = known[d] if d in known else base(text or "")
        assert got[d].base == said(want), (d, (text or "")[:80])
        assert [got[d][f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in want) for i in range(4)]
        every = got[d].spans.split(",") if got[d].spans else []
        assert [s for s in every if not s.startswith("found_")] == (got[d].base.split(",") if got[d].base else [])
        assert len(every) == sum(got[d][f"n_{k}"] for k in (*KINDS, "found"))


def _call_book(known, unknown, other=0):
    """Texts with known phone numbers in a context, and numbers of another shape in it."""
    out = [f"please dial +49 30 {i:03}-55{i:02}1 now" for i in range(known)]
    out += [f"please dial (030) 77{i:02}-12{i} now" for i in range(unknown)]
    return out + [f"please dial {i}0{i}.5{i}x77123 now" for i in range(other)]


def _find(spark, texts):
    rows = list(enumerate(texts))
    out = {}
    for r in personal_data(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        text = texts[r.doc_id]
        out[r.doc_id] = [(k, text[int(a):int(b)]) for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k.startswith("found")]
    return out


def test_contexts_of_known_numbers_find_others(spark):
    texts = _call_book(30, 3) + ["order (030) 7700-120 shipped", "order (040) 9911-222 shipped", "dial 12"]
    got = _find(spark, texts)
    assert got[30] == [("found_phone", "(030) 7700-120")] and got[32] == [("found_phone", "(030) 7702-122")]
    assert got[33] == [("found_phone", "(030) 7700-120")]  # a found number, elsewhere
    assert got[34] == [] and got[35] == [] and not any(got[i] for i in range(30))


def test_contexts_with_too_many_strangers_find_nothing(spark):
    texts = _call_book(20, 3, other=9)
    assert not any(_find(spark, texts).values())
    assert not any(_find(spark, _call_book(3, 1)).values())


def test_found_numbers_carry_on_to_new_contexts(spark):
    near = _call_book(60, 10)
    far = [f"ring {re.search('[(].*[0-9]', t)[0]} soon" for t in near[60:]] + ["ring (0555) 123-4567 soon"]
    got = _find(spark, near + far)
    assert got[len(near)] == [("found_phone", "(030) 7700-120")]
    # ten known fillers, one not: the second round takes the pattern, and the third the number
    assert got[len(near) + 10] == [("found_phone", "(0555) 123-4567")]


def test_copies_add_no_weight(spark):
    copies = ["please dial +49 30 001-5511 now"] * 500 + ["please dial (030) 7700-120 now"]
    assert not any(_find(spark, copies).values())


def test_other_spellings_of_known_values(spark):
    got = _find(spark, ["+49 30 001-5511 a", "see 49300015511, b", 'x tel:"49/30/0015511" c'])
    assert got[1] == [("found_phone", "49300015511")] and got[2] == [("found_phone", "49/30/0015511")]


def brute_found(texts, rounds=3, confidence=0.8):
    """The graph over given fillers, in plain Python."""
    edges, seeds, spots = {}, set(), []
    for d, text in enumerate(texts):
        for m in re.finditer(r"(\S+) (\S+) <([^>]*)> (\S+)", text):
            value = m[3]
            seed = next((k for i, k in enumerate(KINDS) if (0, i, len(value)) in base(value)), None)
            kinds = [seed] if seed else [k for k, ok in (
                ("card", re.fullmatch(r"[0-9](?:[ -]?[0-9]){11,18}", value)), ("phone", re.fullmatch(r"[+(]?[0-9](?:[ ()./-]*[0-9]){5,14}", value))) if ok] or ["other"]
            filler = re.sub("[^a-z0-9@]", "", value.lower())
            for p in (f"1 {m[2]}", f"2 {m[1]} {m[2]}", f"b {m[2]} {m[4]}"):
                for k in kinds:
                    edges.setdefault(p, {}).setdefault(filler, {})[k] = seed is not None or edges.get(p, {}).get(filler, {}).get(k, False)
            if seed:
                seeds.add((filler, seed))
            else:
                spots += [(d, value, filler, k) for k in kinds]
    known = dict.fromkeys(seeds, 1.0)
    for _ in range(rounds):
        good = {}
        for p, fillers in edges.items():
            for kind in KINDS:
                total = sum(known.get((f, kind), 0) for f, ks in fillers.items() if kind in ks)
                if (c := round(total / (len(fillers) + 1), 9)) >= confidence and len(fillers) >= 4:
                    good[p, kind] = c
        logs = {}
        for (p, kind), c in good.items():
            for f, ks in edges[p].items():
                if kind in ks and (f, kind) not in seeds:
                    logs[f, kind] = logs.get((f, kind), 0) + math.log1p(-c)
        known = dict.fromkeys(seeds, 1.0) | {k: round(1 - math.exp(v), 9) for k, v in logs.items()}
    best = {}
    for d, value, filler, k in spots:
        if known.get((filler, k), 0) >= confidence:
            best.setdefault((d, value), []).append((known[filler, k], -KINDS.index(k), k))
    return sorted((d, f"found_{max(v)[2]}", value) for (d, value), v in best.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    cards = [n for n in (str(4 * 10 ** 15 + 97 * i) for i in range(400)) if checksum(n)]

    def value():
        kind = rnd.randrange(10)
        if kind < 3:
            return rnd.choice(cards)
        if kind < 6:
            return f"+44 20 946 0{rnd.randrange(100, 140)}"
        if kind < 8:
            return f"(0{rnd.randrange(20, 22)}) 555-{rnd.randrange(1000, 1003)}"
        return rnd.choice(["4111111111111112", "ref-100000"])

    def line():
        v = value()
        word = rnd.choice(["pay", "call", "fax"]) if rnd.random() < 0.05 else "pay" if v[0] not in "+(" else rnd.choice(["call", "dial", "ring"])
        return f"{rnd.choice(['xx', 'yy'])} {word} <{v}> {rnd.choice(['now', 'soon'])}"

    texts = [line() for _ in range(300)]
    # a bracket keeps number groups apart; the operator sees the same slot without it
    plain = [t.replace("<", "").replace(">", "") for t in texts]
    got = sorted((d, k, v) for d, found in _find(spark, plain).items() for k, v in found)
    want = brute_found(texts)
    assert want and got == want


def test_lexical_patterns_and_checksum(spark):
    df = spark.createDataFrame([("x\nOne Two12:  ", " Then\nnext"), ("", ""), ("a\n", "\nb")], "b string, a string")
    assert [r[0] for r in df.select(lexical_patterns(F.col("b"), F.col("a"))).collect()] == [
        ["1 two00:", "2 one two00:", "b two00: then"], ["1 ^", "2 ^ ^", "b ^ $"], ["1 ^", "2 ^ ^", "b ^ $"]]
    numbers = [str(random.Random(i).randrange(10 ** 12, 10 ** 19)) for i in range(200)]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select(luhn(F.col("n"))).collect()
    assert [r[0] for r in got] == [checksum(n) for n in numbers]


def test_edges_of_the_input(spark):
    schema = "doc_id long, text string, row string, kind int, start string, value long, found string, base int"
    assert personal_data(spark.createDataFrame([], schema)).collect() == []
    mail = (1, "to a@b.cd", "r", 1, "s", 2, "f", 3)
    rows = [mail, mail, (None, None, None, None, None, None, None, None), (None, "1.2.3.4", None, None, None, None, None, None)]
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.base) for r in personal_data(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, 1, 0, "email:3:9"), (1, 1, 0, "email:3:9"), (None, 0, 0, ""), (None, 0, 1, "ip:0:7")], key=str)


def test_query_and_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = {r.doc_id: r for r in op13_pii_bootstrap(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    for r in docs:
        want = base(r.text or "")
        assert got[r.doc_id].base_sha256 == hashlib.sha256(said(want).encode()).hexdigest()
        if not want:
            assert got[r.doc_id].spans == ""


def test_no_python_workers(spark):
    df = personal_data(spark.createDataFrame([(1, "x")], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
