import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import validate as V
from corpusflow.sinks import files as K
from corpusflow.sources import files as S
from corpusflow.sources.conllu import read_conllu_files
from corpusflow.sources.corpus_source import read_files
from goldens import CONLLU_2


def make_corpus(n_raw=5, n_meta=5, skip=(), empty=(), extra=()):
    d = tempfile.mkdtemp(prefix="corpus-")
    for i in range(1, n_raw + 1):
        if ("raw", i) in skip:
            continue
        with open(os.path.join(d, f"{i}_raw.txt"), "w", encoding="utf-8") as f:
            f.write("" if ("raw", i) in empty else f"Текст номер {i}.")
    for i in range(1, n_meta + 1):
        with open(os.path.join(d, f"{i}_meta.json"), "w", encoding="utf-8") as f:
            json.dump({"id": i, "url": f"https://s.ru/{i}", "title": f"T{i}"} if i != 2 else {"url": "u"}, f)
    for name in extra:
        open(os.path.join(d, name), "w").write("x")
    return d


def listing(spark, d):
    return read_files(spark, d, content=False).select("path", "name", "length", "modified")


def violations(spark, d):
    files = V.file_rows(listing(spark, d))
    return sorted(r.rule for r in V.validate_corpus(files).collect())


def test_valid_corpus_and_extra_file(spark):
    d = make_corpus(extra=["3_corrupted.txt", "1_image.png"])
    assert violations(spark, d) == []


def test_empty_directory(spark):
    d = make_corpus(0, 0, extra=["readme.md"])
    assert violations(spark, d) == ["V4_empty_directory"]
    with pytest.raises(ValueError, match="EmptyDirectory"):
        V.raise_on_violation(V.validate_corpus(V.file_rows(listing(spark, d))))


def test_missing_raw_and_unequal(spark):
    assert violations(spark, make_corpus(skip={("raw", 1)})) == ["V6_unequal_counts", "V7_raw_id_gaps"]
    assert violations(spark, make_corpus(3, 2)) == ["V6_unequal_counts"]
    assert violations(spark, make_corpus(empty={("raw", 2)})) == ["V3_empty_file"]


def test_missing_ids_and_balance(spark):
    files = V.file_rows(listing(spark, make_corpus(skip={("raw", 2), ("raw", 4)})))
    raw = files.filter(F.col("kind") == "raw")
    assert [r.missing_id for r in V.missing_ids(raw).orderBy("missing_id").collect()] == [2, 4]
    bal = V.raw_meta_balance(files).orderBy("article_id").collect()
    assert [(r.article_id, r.has_raw, r.has_meta) for r in bal] == [(2, False, True), (4, False, True)]


def test_scan_corpus_with_defaults(spark):
    d = make_corpus(3, 3)
    arts = {r.article_id: r for r in S.read_corpus(spark, d).collect()}
    assert sorted(arts) == [1, 2, 3]
    assert arts[1].text == "Текст номер 1." and arts[1].title == "T1"
    assert arts[2].id == 0 and arts[2].title == ""  # missing keys get defaults


def test_sinks_roundtrip_and_overwrite(spark):
    out = tempfile.mkdtemp(prefix="sink-")
    arts = spark.createDataFrame([(1, "a b"), (2, "c")], "article_id bigint, text string")
    K.write_raw(arts, os.path.join(out, "raw"))
    K.write_raw(arts.filter("article_id = 2"), os.path.join(out, "raw"))
    assert [r.article_id for r in spark.read.parquet(os.path.join(out, "raw")).collect()] == [2]
    K.write_meta(arts.withColumn("title", F.lit("t")), os.path.join(out, "meta"))
    meta = [json.loads(r.value) for r in spark.read.text(os.path.join(out, "meta")).collect()]
    assert sorted(m["id"] for m in meta) == [1, 2]
    assert set(meta[0]) == {"id", "url", "title", "date", "author", "topics", "pos_frequencies",
                            "pattern_matches"}


def test_conllu_files(spark):
    d = tempfile.mkdtemp(prefix="conllu-")
    open(os.path.join(d, "2_udpipe.conllu"), "w", encoding="utf-8").write(CONLLU_2)
    df = read_conllu_files(spark, d)
    assert df.select("article_id").first()[0] == 2
    open(os.path.join(d, "3_udpipe.conllu"), "w").close()
    with pytest.raises(Exception, match="EmptyFile"):
        read_conllu_files(spark, d).collect()
    assert read_conllu_files(spark, d, strict=False).count() == 2


def test_write_cleaned_and_artifact_names(spark):
    from corpusflow.functions import paths as P
    from corpusflow.functions.text import clean_text
    out = tempfile.mkdtemp(prefix="clean-")
    arts = spark.createDataFrame([(1, "Привет, Мир!")], "article_id bigint, text string")
    K.write_cleaned(arts.select("article_id", clean_text("text").alias("cleaned")), os.path.join(out, "c"))
    assert spark.read.parquet(os.path.join(out, "c")).first().cleaned == "привет мир"
    names = arts.select(*[P.artifact_name(F.col("article_id"), F.lit(k)).alias(k) for k in P.ARTIFACT_SUFFIX]).first()
    assert tuple(names) == ("1_raw.txt", "1_meta.json", "1_cleaned.txt", "1_udpipe.conllu")
    with pytest.raises(Exception, match="unknown artifact kind"):
        arts.select(P.artifact_name(F.col("article_id"), F.lit("image"))).collect()
