"""Part-of-speech statistics over TOKEN tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Bar colours of the frequency chart, cycled by rank.
CHART_COLOURS = ["b", "g", "r", "c"]
# ---------------------------------------------------------------------------


def pos_frequencies(tokens: DataFrame) -> DataFrame:
    """A1: tokens per UPOS per article -> ``(article_id, upos, n)``.

    A hash aggregate with map-side partial counts: a huge article costs one
    partial row per (task, upos), so key skew does not reach the shuffle.
    """
    return tokens.groupBy("article_id", "upos").agg(F.count(F.lit(1)).alias("n"))


def pos_counts_ordered(tokens: DataFrame) -> DataFrame:
    """A1 plus the first position of each tag -> ``(article_id, upos, n, first_pos)``."""
    return tokens.groupBy("article_id", "upos").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("sent_id", "id")).alias("first_pos"),
    )


def pos_frequency_map(tokens: DataFrame) -> DataFrame:
    """A2: ``(article_id, pos_frequencies map, pos_json)``, keys in order of first
    appearance.  The per-article collect is bounded by the number of tags."""
    counts = pos_counts_ordered(tokens)
    entries = F.transform(
        F.array_sort(F.collect_list(F.struct("first_pos", "upos", "n"))),
        lambda e: F.struct(e["upos"].alias("key"), e["n"].alias("value")),
    )
    return (counts.groupBy("article_id")
            .agg(F.map_from_entries(entries).alias("pos_frequencies"))
            .withColumn("pos_json", F.to_json("pos_frequencies")))


def pos_ranking(tokens: DataFrame) -> DataFrame:
    """Rank tags per article by count descending, ties by first appearance."""
    counts = pos_counts_ordered(tokens)
    w = Window.partitionBy("article_id").orderBy(F.desc("n"), F.asc("first_pos"))
    return counts.select("article_id", "upos", "n",
                         F.row_number().over(w).alias("rank"))


def top_pos_tags(tokens: DataFrame, k: int = 3) -> DataFrame:
    """L3: the ``k`` most frequent tags of each article (a top-k report)."""
    return pos_ranking(tokens).filter(F.col("rank") <= k)


def pos_chart_rows(tokens: DataFrame) -> DataFrame:
    """The bar chart as rows: rank, tag, count, colour, y limit (= max + 1)."""
    ranked = pos_ranking(tokens)
    w = Window.partitionBy("article_id")
    colours = F.array(*[F.lit(c) for c in CHART_COLOURS])
    return ranked.select(
        "article_id", "rank", "upos", "n",
        F.element_at(colours, ((F.col("rank") - 1) % len(CHART_COLOURS) + 1).cast("int")).alias("colour"),
        (F.max("n").over(w) + 1).alias("y_limit"),
    )


def pos_report(tokens: DataFrame, articles: DataFrame) -> DataFrame:
    """Count -> frequency map -> attach to the article rows (left join on id).

    The article side keeps every article; articles without tokens get null."""
    freq = pos_frequency_map(tokens).select("article_id", "pos_frequencies")
    return articles.join(freq, on="article_id", how="left")


def duplicate_texts(articles: DataFrame) -> DataFrame:
    """Texts held by more than one article -> ``(text_sha256, n_copies,
    first_article_id)``.

    Grouped on a SHA-256 digest of the text: the shuffle moves 32-byte keys,
    not whole texts, and partial aggregation absorbs a text copied a million
    times.
    """
    return (articles.groupBy(F.sha2(F.col("text"), 256).alias("text_sha256"))
            .agg(F.count(F.lit(1)).alias("n_copies"), F.min("article_id").alias("first_article_id"))
            .filter(F.col("n_copies") > 1))
