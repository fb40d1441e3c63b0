"""Table sinks of the corpus (K3-K5, K7, K9).

Articles are written as partitioned tables, not one small file per article;
``artifact_name`` keeps the per-article file names as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.dates import META_DATE_FORMAT
from corpusflow.sources.files import parse_meta_json

META_FIELDS = ("id", "url", "title", "date", "author", "topics", "pos_frequencies",
               "pattern_matches")


def meta_struct(articles: DataFrame) -> Column:
    """The eight meta fields; ``date`` as ``yyyy-MM-dd HH:mm:ss`` text or null."""
    cols = set(articles.columns)

    def pick(name, default):
        return F.col(name) if name in cols else default

    date = pick("date", F.lit(None))
    date_text = F.date_format(date, META_DATE_FORMAT) if "date" in cols and dict(
        articles.dtypes)["date"].startswith("timestamp") else date.cast("string")
    return F.struct(
        pick("article_id", pick("id", F.lit(None).cast("bigint"))).alias("id"),
        pick("url", F.lit(None).cast("string")).alias("url"),
        pick("title", F.lit("")).alias("title"),
        date_text.alias("date"),
        pick("author", F.array().cast("array<string>")).alias("author"),
        pick("topics", F.array().cast("array<string>")).alias("topics"),
        pick("pos_frequencies", F.create_map().cast("map<string,bigint>")).alias("pos_frequencies"),
        pick("pattern_matches", F.create_map().cast("map<string,string>")).alias("pattern_matches"),
    )


def meta_json(articles: DataFrame) -> Column:
    """K5: the meta record as JSON text, null fields kept.

    ``pattern_matches`` that is JSON text already (as in ARTICLE and META) is
    put in as JSON, not as an escaped string; text that is no JSON becomes null.
    """
    types = dict(articles.dtypes)
    if types.get("pattern_matches") != "string":
        return F.to_json(meta_struct(articles), {"ignoreNullFields": "false"})
    rest = F.to_json(meta_struct(articles).dropFields("pattern_matches"), {"ignoreNullFields": "false"})
    text = F.col("pattern_matches")
    valid = F.when(F.coalesce(F.get_json_object(text, "$"), F.lit("")) != "", text).otherwise(F.lit("null"))
    return F.concat(F.substring(rest, F.lit(1), F.length(rest) - 1), F.lit(',"pattern_matches":'), valid, F.lit("}"))


def write_raw(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: ``(article_id, text)``; ``mode="overwrite"`` replaces the folder (K7)."""
    articles.select("article_id", "text").write.mode(mode).parquet(path)


def write_cleaned(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: ``(article_id, cleaned)``."""
    articles.select("article_id", "cleaned").write.mode(mode).parquet(path)


def write_meta(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: one JSON meta record per line."""
    articles.select(meta_json(articles).alias("value")).write.mode(mode).text(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """META rows of a folder written by ``write_meta`` (``pattern_matches`` as JSON text)."""
    return parse_meta_json(spark.read.text(path).select(F.col("value").alias("meta_json")))


def update_meta(meta: DataFrame, counts: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """META rows with new POS counts and pattern matches put in.

    ``counts(article_id, pos_frequencies map)``, ``matches(article_id, pattern_matches
    map or JSON text)``.  What an update does not give stays as it was (D1): counting
    keeps earlier matches, and an article without new counts keeps its old ones.
    The joins are on the id alone; both updates hold one row per article.
    """
    out = meta
    if counts is not None:
        new = counts.select(F.col("article_id").alias("id"), F.col("pos_frequencies").alias("_counts"))
        out = out.join(new, on="id", how="left").withColumn(
            "pos_frequencies", F.coalesce("_counts", "pos_frequencies")).drop("_counts")
    if matches is not None:
        text = F.col("pattern_matches") if dict(matches.dtypes)["pattern_matches"] == "string" else F.to_json("pattern_matches")
        new = matches.select(F.col("article_id").alias("id"), text.alias("_matches"))
        out = out.join(new, on="id", how="left").withColumn(
            "pattern_matches", F.coalesce("_matches", "pattern_matches")).drop("_matches")
    return out.select(*meta.columns)
