import os
import tempfile

from pyspark.sql import functions as F

from corpusflow.operators.html import parse_pages
from corpusflow.streaming import articles as S

SCHEMA = "page_id bigint, url string, html string"


def page(i, url, text):
    return i, f"https://s.ru/{url}", f"<html><article><p>{text}</p></article></html>"


A1 = page(1, "a", "The cat sat on the old mat. A dog was here too! It ran away from 3 cats.")
A2 = page(11, "a", "The bird is on the mat. It sang all day.")
B1 = page(2, "b", "Nothing of note was in the paper. The end of it.")
C1 = page(3, "c", "A third page came in later, and with it a word.")
B2 = page(12, "b", "")


def arrive(spark, base, step, rows):
    path = os.path.join(base, "landed", str(step))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    S.run_updates(spark, os.path.join(base, "landed"), base, article_classes=None)


def scratch_totals(spark, pages):
    texts = parse_pages(spark.createDataFrame(pages, SCHEMA), None).select("url", F.lit(1).alias("version"), "text")
    return {r.upos: r.n for r in S.token_counts(texts).groupBy("upos").agg(F.sum("n").alias("n")).collect()}


def totals(spark, base):
    return {r.upos: r.n for r in S.pos_totals(spark, base).collect()}


def current(spark, base):
    return sorted((r.url[-1], r.version, r.page_id) for r in S.current_articles(spark, base).collect())


def test_three_batches_equal_counting_from_scratch(spark):
    base = tempfile.mkdtemp(prefix="updates-")
    arrive(spark, base, 0, [A1, B1])
    assert totals(spark, base) == scratch_totals(spark, [A1, B1])
    arrive(spark, base, 1, [A2, B1, C1])  # one changed, one as it was, one new
    assert current(spark, base) == [("a", 2, 11), ("b", 1, 2), ("c", 1, 3)]
    assert totals(spark, base) == scratch_totals(spark, [A2, B1, C1])
    arrive(spark, base, 2, [B2, A1, (None, "https://s.ru/x", "no id"), (9, None, "no url")])  # emptied, and back to the first text
    assert current(spark, base) == [("a", 3, 1), ("b", 2, 12), ("c", 1, 3)]
    assert totals(spark, base) == scratch_totals(spark, [A1, B2, C1])
    cleaned = {r.url[-1]: r.cleaned for r in S.current_articles(spark, base).collect()}
    assert cleaned["b"] == "" and cleaned["a"].startswith("the cat sat on the old mat a dog")
    # nothing new has landed, and what arrives again as it was, changes nothing
    S.run_updates(spark, os.path.join(base, "landed"), base, article_classes=None)
    arrive(spark, base, 3, [A1, C1])
    assert current(spark, base) == [("a", 3, 1), ("b", 2, 12), ("c", 1, 3)] and totals(spark, base) == scratch_totals(spark, [A1, B2, C1])


def test_a_repeated_batch_writes_the_same_rows(spark):
    base = tempfile.mkdtemp(prefix="updates-")
    changed = "url string, version int, page_id long, digest string, html string"
    first = spark.createDataFrame([(A1[1], 1, 1, "d1", A1[2]), (B1[1], 1, 2, "d2", B1[2])], changed)
    second = spark.createDataFrame([(A2[1], 2, 11, "d3", A2[2])], changed)
    update = S.apply_update(base, None)
    for batch, epoch in ((first, 0), (second, 1), (second, 1), (first, 0), (second, 1)):
        update(batch, epoch)
    assert current(spark, base) == [("a", 2, 11), ("b", 1, 2)]
    assert totals(spark, base) == scratch_totals(spark, [A2, B1])


def test_of_several_pages_of_one_url_the_last_counts(spark):
    base = tempfile.mkdtemp(prefix="updates-")
    arrive(spark, base, 0, [A2, A1, A1])
    assert current(spark, base) == [("a", 1, 11)] and totals(spark, base) == scratch_totals(spark, [A2])


def test_before_anything_arrives(spark):
    base = tempfile.mkdtemp(prefix="updates-")
    assert S.current_articles(spark, base).collect() == [] and S.pos_totals(spark, base).collect() == []
