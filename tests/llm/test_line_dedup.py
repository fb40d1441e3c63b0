import random

import pytest

from corpusflow.llm.line_dedup import line_dedup

SPACE = " \t\r\x0b\x0c"


def brute(docs, ratio, least):
    """docs: (id, host, text)."""
    pages, held = {}, {}
    for _, h, t in docs:
        if h is not None:
            pages[h] = pages.get(h, 0) + 1
            for line in {x.strip(SPACE) for x in (t or "").split("\n")} - {""}:
                held[h, line] = held.get((h, line), 0) + 1
    drop = {k for k, n in held.items() if n >= least and n > ratio * pages[k[0]]}
    return [(d, h, t if d is None or h is None or t is None else
             "\n".join(x for x in t.split("\n") if (h, x.strip(SPACE)) not in drop)) for d, h, t in docs]


def _docs(seed):
    rnd = random.Random(seed)
    lines = ["menu", "  menu\t", "footer é", "a", "", " ", "ad\r", "only here"]
    out = [(None, "h0", "menu\nx"), (900, None, "menu\nmenu"), (901, "h0", None), (902, "h0", "")]
    for i in range(200):
        body = [rnd.choice(lines) if rnd.random() < 0.3 else f"text {rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(8))]
        out.append((i, "h0" if i % 3 == 0 else f"h{rnd.randrange(6)}", "\n".join(body)))
    return out


@pytest.mark.parametrize(("ratio", "least"), [(0.1, 5), (0.25, 2), (0.0, 1)])
def test_against_brute_force(spark, ratio, least):
    docs = _docs(int(ratio * 100))
    rows = [(d, t, h, None if t is None else len(t), "x") for d, h, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, line string")
    got = line_dedup(df, ratio, least)
    assert got.schema == df.schema
    want = [(d, t, h, None if t is None else len(t), "x") for d, h, t in brute(docs, ratio, least)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_edges_of_the_input(spark):
    schema = "host string, doc_id long, text string, source string, pages long"
    assert line_dedup(spark.createDataFrame([], schema)).collect() == []
    rows = [("q", 1, "same\nown", "s", 1), ("q", 1, "same\nown", "s", 1), (None, 2, "same\n" + "z" * 2_000_000, "s", None)]
    got = line_dedup(spark.createDataFrame(rows, schema), ratio=0.9, min_pages=3)
    assert got.columns == ["host", "doc_id", "text", "source", "pages"]
    assert sorted(len(r.text) for r in got.collect()) == [3, 3, 2_000_000]


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    plan = line_dedup(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))
