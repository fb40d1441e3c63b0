"""Spark schemas of the corpus data model."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("author", T.ArrayType(T.StringType())),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("text", T.StringType()),
    T.StructField("pos_frequencies", T.MapType(T.StringType(), T.LongType())),
    T.StructField("pattern_matches", T.StringType()),
])

# Meta JSON as written per article.  ``pattern_matches`` is kept as raw JSON.
META = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("author", T.ArrayType(T.StringType())),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("pos_frequencies", T.MapType(T.StringType(), T.LongType())),
    T.StructField("pattern_matches", T.StringType()),
])

TOKEN_COLUMNS = ("article_id", "sent_id", "id", "form", "lemma", "upos", "xpos",
                 "feats", "head", "deprel", "deps", "misc")

TOKEN = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("sent_id", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("form", T.StringType()),
    T.StructField("lemma", T.StringType()),
    T.StructField("upos", T.StringType()),
    T.StructField("xpos", T.StringType()),
    T.StructField("feats", T.StringType()),
    T.StructField("head", T.IntegerType()),
    T.StructField("deprel", T.StringType()),
    T.StructField("deps", T.StringType()),
    T.StructField("misc", T.StringType()),
])

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

LINK = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("kind", T.StringType()),
])

FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("file_id", T.LongType()),
    T.StructField("kind", T.StringType()),
])

NODE = T.StructType([
    T.StructField("graph_id", T.StringType()),
    T.StructField("node_id", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("text", T.StringType()),
])

EDGE = T.StructType([
    T.StructField("graph_id", T.StringType()),
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("label", T.StringType()),
])
