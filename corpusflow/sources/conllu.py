"""S3: CoNLL-U text -> TOKEN rows; file source with empty-file handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.conllu import is_token_line
from corpusflow.sources.corpus_source import read_files


def parse_conllu(docs: DataFrame, text_col: str = "conllu", id_col: str = "article_id") -> DataFrame:
    """Parse CoNLL-U documents into TOKEN rows (+ ``text`` of the sentence).

    Sentences are the non-blank blocks separated by blank lines; ``sent_id`` is
    0-based.  Only lines whose first field is an integer are tokens.  All work
    is row-local (no shuffle).
    """
    blocks = F.filter(F.split(F.col(text_col), r"\r?\n[ \t]*\r?\n"), lambda b: F.trim(b) != "")
    sents = docs.select(F.col(id_col).alias("article_id"),
                        F.posexplode(blocks).alias("sent_id", "block"))
    lines = sents.select(
        "article_id", F.col("sent_id").cast("int").alias("sent_id"),
        F.regexp_extract("block", r"(?m)^# text = ([^\r\n]*)", 1).alias("text"),
        F.explode(F.split("block", r"\r?\n")).alias("line")).filter(is_token_line(F.col("line")))
    f = F.split("line", "\t")

    def field(i: int) -> Column:
        return F.get(f, i)

    return lines.select(
        "article_id", "sent_id",
        field(0).cast("int").alias("id"), field(1).alias("form"), field(2).alias("lemma"),
        field(3).alias("upos"), field(4).alias("xpos"), field(5).alias("feats"),
        field(6).cast("int").alias("head"), field(7).alias("deprel"), field(8).alias("deps"),
        field(9).alias("misc"), "text")


def read_conllu_files(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read ``N_udpipe.conllu`` files whole -> ``(article_id, conllu, empty)``; the
    article id is the file-name prefix.

    Zero-length files are rows like any others: with ``strict`` reading one raises
    ``EmptyFile``, otherwise it has ``empty = true`` and no text.
    """
    files = read_files(spark, path, ("udpipe",))
    empty = F.col("length") == 0
    if strict:
        said = F.concat(F.lit("EmptyFile: the conllu of article "), F.col("article_id").cast("string"), F.lit(" is empty"))
        files = files.withColumn("text", F.when(empty, F.raise_error(said)).otherwise(F.col("text")))
    return files.select("article_id", F.col("text").alias("conllu"), empty.alias("empty"))
