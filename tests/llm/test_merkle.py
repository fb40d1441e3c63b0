import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusflow.llm.merkle import build, fold, grow, height, manifest, position, siblings
from corpusflow.llm.queries_manifest import op12_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, i):
    """(siblings before, siblings behind) per level."""
    out = []
    for nodes in tree[:-1]:
        run = i - i % 3
        out.append((nodes[run:i], nodes[i + 1:run + 3]))
        i //= 3
    return out


def brute(rows, tampered):
    trees = {}
    for r in rows:
        trees.setdefault("0" if r["source"] is None else "1" + r["source"], []).append(r)
    for own in trees.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    built = {k: levels([leaf(r, r["text"]) for r in own]) for k, own in trees.items()}
    keys = sorted(built, key=str.encode)
    top = levels([built[k][-1][0] for k in keys])
    out = []
    for at, k in enumerate(keys):
        for i, r in enumerate(trees[k]):
            steps = way(built[k], i) + way(top, at)
            node = leaf(r, tampered(r))
            for before, behind in steps:
                node = h(*before, node, *behind)
            out.append((r["doc_id"], built[k][0][i], built[k][-1][0], top[-1][0],
                        h(*(x for step in steps for side in step for x in side)), node, node == top[-1][0]))
    return sorted(out, key=str)


def no_breaks(r):
    if r["text"] is None or r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2:
        return r["text"]
    return r["text"].replace("\n", "")


def odd():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 31, 82])
def test_places_in_the_log_are_those_of_completion(n):
    top = height(n)
    log = list(grow([str(i) for i in range(n)], 0, 0, n, top))
    assert [position(level, i, n, top) for level, i, _ in log] == list(range(len(log)))
    assert log[-1][:2] == (top, 0)
    tree = levels([str(i) for i in range(n)])
    assert all(tree[level][i] == node for level, i, node in log) and len(log) == sum(map(len, tree))


@pytest.mark.parametrize("span", [1, 2, 8])
def test_against_brute_force(spark, span):
    rnd = random.Random(span)
    rows = [{"doc_id": rnd.choice([None, rnd.randrange(200), rnd.randrange(-2 ** 62, 2 ** 62)]), "source": rnd.choice(["a", "a", "a", "", "b é", "日", None]),
             "lang": rnd.choice(["en", None, ""]), "n_chars": rnd.choice([None, 0, 7]),
             "text": rnd.choice([None, "", "a\nb", "plain", "x" * 5000 + "\n", "é\n\n"])} for _ in range(170)]
    rows += [rows[0], rows[0], rows[1]]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5)
    df = df.withColumn("tree", F.lit("x")).withColumn("index", F.lit(1)).withColumn("digest", F.lit("y"))
    got = manifest(df, odd(), span)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == brute(rows, no_breaks)
    assert {r[-1] for r in found} == {True, False}


def test_a_tree_of_more_leaves_than_a_builder_takes(spark):
    n = 1000
    rows = [{"doc_id": i, "source": "hot" if i % 3 else f"s{i % 50}", "lang": "en", "n_chars": i, "text": f"t\n{i}"} for i in range(n)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(7)
    assert sorted(map(tuple, manifest(df, odd(), 2).collect()), key=str) == brute(rows, no_breaks)
    entries = spark.range(n).select(F.lit("t").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("id").alias("index"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    logs = build(entries, 2)
    assert len(logs) == 4  # 1000 leaves, 9 a builder
    places = {r.position: r.digest for log in logs for r in log.collect()}
    assert sorted(places) == list(range(sum(-(-n // 3 ** g) for g in range(height(n) + 1))))


def test_without_tampering_all_rows_verify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = manifest(docs).collect()
    assert len(got) == docs.count() and all(r.verified and r.folded_root == r.root for r in got)


def test_a_lone_row_and_no_row(spark):
    one = spark.createDataFrame([(1, "s", None, None, "x")], SCHEMA)
    (got,) = manifest(one).collect()
    assert got.leaf == got.subroot == got.root == got.folded_root and got.proof_sha256 == h() and got.verified
    assert manifest(one.limit(0)).collect() == []
    assert fold("a", "") == "a" and siblings("") == ""


def test_query(spark):
    docs = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(map(tuple, op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()), key=str) == brute(docs, no_breaks)
