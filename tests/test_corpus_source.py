import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusflow.sources import corpus_source as C


def folder():
    return tempfile.mkdtemp(prefix="corpus-source-")


def all_files(d):
    return sorted(os.path.relpath(os.path.join(at, n), d) for at, _, names in os.walk(d) for n in names if not n.endswith(".crc"))


def test_ten_thousand_small_files(spark):
    d = folder()
    for i in range(10_000):
        at = d if i % 4 else os.path.join(d, f"part{i % 3}")
        os.makedirs(at, exist_ok=True)
        with open(os.path.join(at, f"{i}_raw.txt"), "w", encoding="utf-8") as f:
            f.write("" if i % 100 == 7 else f"Текст {i}\n")
    for name in ("1_image.png", "x_raw.txt", "1_raw.txt.tmp", "notes.md"):
        open(os.path.join(d, name), "w").write("no corpus file")
    df = C.read_files(spark, d, ("raw",), partitions=8)
    assert df.rdd.getNumPartitions() >= 8
    sums = df.agg(F.count("*").alias("n"), F.countDistinct("article_id").alias("ids"), F.sum((F.col("length") == 0).cast("int")).alias("empty"),
                  F.sum((F.col("text") == F.concat(F.lit("Текст "), F.col("article_id"), F.lit("\n"))).cast("int")).alias("right")).first()
    assert (sums.n, sums.ids, sums.empty, sums.right) == (10_000, 10_000, 100, 9_900)
    sizes = C.read_files(spark, d, content=False).agg(F.sum("length"), F.count("text")).first()
    assert sizes[0] == sum(os.path.getsize(os.path.join(d, f)) for f in all_files(d) if f.endswith("_raw.txt") and "x_raw" not in f) and sizes[1] == 0


def test_many_folders_are_dealt_out_in_ranges():
    d = folder()
    for i in range(40):
        os.makedirs(os.path.join(d, f"f{i:02}"))
    parts = C.CorpusReader({"path": d, "partitions": "8"}).partitions()
    assert len(parts) <= 8 and sorted(x for p in parts for x in p.folders) == sorted([d, *(os.path.join(d, f"f{i:02}") for i in range(40))])
    assert {(p.at, p.of) for p in parts} == {(0, 1)}
    alone = C.CorpusReader({"path": os.path.join(d, "f00"), "partitions": "8"}).partitions()
    assert [(p.at, p.of) for p in alone] == [(i, 8) for i in range(8)]


def test_missing_folders_and_kinds(spark):
    d = folder()
    with pytest.raises(Exception, match="no such folder"):
        C.read_files(spark, os.path.join(d, "gone")).collect()
    open(os.path.join(d, "file"), "w").close()
    with pytest.raises(Exception, match="no folder"):
        C.read_files(spark, os.path.join(d, "file")).collect()
    with pytest.raises(Exception, match="unknown artifact kind"):
        C.read_files(spark, d, ("image",)).collect()
    assert C.read_files(spark, d).collect() == []


def test_round_trip(spark):
    d = folder()
    rows = [(i, None if i == 3 else "" if i == 4 else f"é {i}\r\nb\n", json.dumps({"id": i, "title": f"T{i}", "url": "u"})) for i in [1, 2, 3, 4, 10_000, 25_001]]
    arts = spark.createDataFrame(rows, "article_id long, text string, meta string").repartition(3)
    C.write_files(C.article_files(arts, raw=F.col("text"), meta=F.col("meta")), d)
    assert all_files(d) == sorted(["_SUCCESS", *(f"{i // 10000:06d}/{i}_raw.txt" for i, t, _ in rows if t is not None), *(f"{i // 10000:06d}/{i}_meta.json" for i, _, _ in rows)])
    got = {(r.article_id, r.kind): r.text for r in C.read_files(spark, d).collect()}
    assert got == {(i, k): t for i, raw, meta in rows for k, t in (("raw", raw), ("meta", meta)) if t is not None}
    found = {r.article_id: (r.text, r.title) for r in C.read_articles(spark, d).collect()}
    assert found == {i: (t, f"T{i}") for i, t, _ in rows if t is not None}
    # appending replaces files of the same name, overwriting replaces all
    C.write_files(arts.filter("article_id = 1").select("article_id", F.lit("raw").alias("kind"), F.lit("new").alias("text")), d, mode="append")
    assert {(r.article_id, r.text) for r in C.read_files(spark, d, ("raw",)).collect()} >= {(1, "new"), (4, "")}
    C.write_files(arts.filter("article_id = 2").select("article_id", F.lit("raw").alias("kind"), "text"), d, folders=False)
    assert all_files(d) == ["2_raw.txt", "_SUCCESS"]


def test_a_failing_task_leaves_no_half_file(spark):
    d = folder()
    good = spark.range(200).select(F.col("id").alias("article_id"), F.lit("raw").alias("kind"), F.lit("x" * 1000).alias("text")).repartition(4)
    # a task that fails after many of its files are written
    bad = good.select("article_id", F.when(F.col("article_id") == 177, "broken").otherwise(F.col("kind")).alias("kind"), "text").coalesce(1).sortWithinPartitions("article_id")
    with pytest.raises(Exception, match="unknown artifact kind: broken"):
        C.write_files(bad, d)
    assert all_files(d) == []
    with pytest.raises(Exception, match="unknown artifact kind: broken"):
        C.write_files(good.withColumn("kind", F.when(F.col("article_id") == 177, "broken").otherwise(F.col("kind"))), d)
    left = all_files(d)  # what other tasks have finished is whole
    assert "_SUCCESS" not in left and not any(f.startswith("_temporary") for f in left)
    assert all(os.path.getsize(os.path.join(d, f)) == 1000 for f in left)
    C.write_files(good, d)
    assert len(all_files(d)) == 201


def test_a_repeated_task_writes_the_same_files():
    import pyarrow as pa
    from pyspark.sql.types import StructType
    d = folder()
    schema = StructType().add("text", "string").add("kind", "string").add("article_id", "long")
    writer = C.CorpusWriter({"path": d}, schema, True)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", None]), pa.array(["raw", "udpipe"]), pa.array([5, 6])], ["text", "kind", "article_id"])

    def dies():
        yield batch
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    assert not [f for f in all_files(d) if not f.startswith("_temporary")]
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    writer.commit([first, second])
    assert all_files(d) == ["000000/5_raw.txt", "000000/6_udpipe.conllu", "_SUCCESS"] and first == second
