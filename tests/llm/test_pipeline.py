import pyarrow as pa

import corpus_pipeline
from corpusflow.llm import line_dedup as ld
from corpusflow.llm.secret_crf import block_spans, fit
from corpusflow.llm.textblocks import blocks
from corpusflow.llm.weak_supervision import quality
from tests.llm.brute import jaccard_components
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import PATH, _whole

SF = "/root/testdata/sf0.001"


def _staged(spark, rows, like):
    return spark.createDataFrame(rows, like.schema)


def test_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    at = docs.columns.index("text")

    kept = {r.doc_id for r in quality(docs).filter("kept").collect()}
    one = stages["quality_rules"](spark, docs, SF)
    assert one.schema == docs.schema
    rows = sorted(map(tuple, one.collect()))
    assert rows == sorted(tuple(r) for r in docs.collect() if r.doc_id in kept)

    two = stages["line_dedup"](spark, _staged(spark, rows, docs), SF)
    want = {d: t for d, _, t in brute_lines([(r[0], r[3], r[at]) for r in rows], ld.RATIO, ld.MIN_PAGES)}
    rows = sorted(map(tuple, two.collect()))
    assert {r[0]: r[at] for r in rows} == want
    assert all(r[4] == len(r[at]) for r in rows)

    three = stages["ngram_jaccard_join"](spark, _staged(spark, rows, docs), SF)
    own = jaccard_components([(r[0], r[at]) for r in rows], 5, 80, 100)
    got = sorted(map(tuple, three.collect()))
    assert got == [r for r in rows if own[r[0]][1] == r[0]]
    assert len(got) < len(rows)
    rows = [tuple(v + ' token = "0123456789abcdef0123"' if i == at and n % 20 == 0 else v for i, v in enumerate(r)) for n, r in enumerate(got)]

    df = _staged(spark, rows, docs)
    field = fit(df)
    hidden = {}
    for lo, _, words in blocks(pa.array([r[at] for r in rows])):
        for i, (_, spans) in enumerate(block_spans(field, words), lo):
            text, out, end = rows[i][at], "", 0
            for a, _, b in spans:
                if a >= end:
                    out += text[end:a] + "[secret]"
                end = max(end, b)
            hidden[rows[i][0]] = out + text[end:]
    got = sorted(map(tuple, stages["secret_scans"](spark, df, SF).collect()))
    assert {r[0]: r[at] for r in got} == hidden and any("[secret]" in t for t in hidden.values())

    packed = stages["best_fit_packing"](spark, _staged(spark, got, docs), SF).collect()
    n = _whole(packed, [(r[0], r[at]) for r in got], Tokenizer.from_file(PATH), 4096)
    assert n <= sum(r.length for r in packed) / 4096 + 2
    packed = stages["best_fit_packing"](spark, _staged(spark, three.collect(), docs), SF).collect()
    final = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert final == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)


def test_an_empty_table_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    schema = "key long, doc_id long, text string, lang string, source string, n_chars long, component_id string, votes string"
    long = " ".join(f"word{i}" for i in range(90))
    df = spark.createDataFrame([(1, 1, long, None, None, None, "a", "b"), (None, None, long, "en", "s", 5, None, None),
                                (1, 2, None, "en", "s", 0, "a", "b")], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, SF).collect(), df.schema)
        assert df.count() == 2
    assert corpus_pipeline.ORACLE_SQL is None


def test_names_are_those_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
