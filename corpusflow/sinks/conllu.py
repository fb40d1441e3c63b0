"""K1 / K2: render TOKEN tables as CoNLL-U documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.conllu import FIELDS, token_line, underscore_if_empty


def render_sentences(tokens: DataFrame, sentences: DataFrame | None = None,
                     include_feats: bool = True, one_based: bool = True) -> DataFrame:
    """One CoNLL-U block per sentence -> ``(article_id, sent_id, block)``.

    Block = ``# sent_id = n`` (1-based unless ``one_based=False``), ``# text = ...``,
    ten fields per token (missing -> ``_``), then a blank line.  The text comes
    from ``sentences(article_id, sent_id, sentence)`` when given, else the forms
    joined by spaces (no space after a token marked ``SpaceAfter=No``).
    """
    per_tok = tokens.select(
        "article_id", "sent_id",
        F.struct(F.col("id"), token_line(include_feats).alias("line"),
                 F.col("form"),
                 F.when(F.col("misc").contains("SpaceAfter=No"), "").otherwise(" ").alias("sep")
                 ).alias("t"))
    grouped = per_tok.groupBy("article_id", "sent_id").agg(
        F.array_sort(F.collect_list("t")).alias("ts"))
    lines = F.array_join(F.transform("ts", lambda t: t["line"]), "\n")
    if sentences is not None:
        grouped = grouped.join(
            sentences.select("article_id", "sent_id", F.col("sentence").alias("text")),
            on=["article_id", "sent_id"], how="left")
        text = F.coalesce(F.col("text"), F.lit(""))
    else:
        text = F.rtrim(F.array_join(F.transform("ts", lambda t: F.concat(t["form"], t["sep"])), ""))
    number = F.col("sent_id") + 1 if one_based else F.col("sent_id")
    block = F.concat(F.lit("# sent_id = "), number.cast("string"), F.lit("\n# text = "), text,
                     F.lit("\n"), lines, F.lit("\n\n"))
    return grouped.select("article_id", "sent_id", block.alias("block"))


def render_conllu(tokens: DataFrame, sentences: DataFrame | None = None,
                  include_feats: bool = True) -> DataFrame:
    """K1: one CoNLL-U document per article -> ``(article_id, conllu)``.

    The per-article collect holds the blocks of one input document, so its
    size is bounded by the largest single text, not by the corpus.  Tokens that
    bring their sentence's ``text`` on its first token (``annotate_rules(...,
    with_text=True)``, ``parse_conllu``) need one exchange, on the article.
    """
    if sentences is None and "text" in tokens.columns:
        return _render_with_text(tokens, include_feats)
    blocks = render_sentences(tokens, sentences, include_feats)
    return blocks.groupBy("article_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_id", "block"))),
                                 lambda b: b["block"]), "").alias("conllu"))


def render_sentence_rows(sents: DataFrame, include_feats: bool = True, merged: bool = False) -> DataFrame:
    """K1 / K2 on sentence rows ``(article_id, sent_id, sentence, tokens)``: ``(article_id, conllu)``.

    A sentence's block is made inside its row; one exchange brings an article's blocks
    together, which is bounded by one article.  Sentences of one article and number are blocks
    of their own, or with ``merged`` one block, as in ``render_conllu`` of their tokens.
    """
    numbers = {f.name for f in sents.schema["tokens"].dataType.elementType if f.dataType.typeName() in ("integer", "long")}

    def field(t: Column, f: str) -> Column:
        if f == "feats" and not include_feats:
            return F.lit("_")
        return F.coalesce(t[f].cast("string"), F.lit("_")) if f in numbers else underscore_if_empty(t[f])

    def line(t: Column) -> Column:
        return F.concat_ws("\t", *[field(t, f) for f in FIELDS])

    if merged:
        parts = F.struct("sent_id", F.coalesce("sentence", F.lit("")).alias("text"), F.transform("tokens", line).alias("lines"))
        return _render_merged(sents.select("article_id", parts.alias("b")))
    block = F.concat(F.lit("# sent_id = "), (F.col("sent_id") + 1).cast("string"), F.lit("\n# text = "), F.coalesce("sentence", F.lit("")),
                     F.lit("\n"), F.array_join(F.transform("tokens", line), "\n"), F.lit("\n\n"))
    blocks = sents.select("article_id", F.struct("sent_id", block.alias("block")).alias("b"))
    return blocks.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["block"]), "").alias("conllu"))


def _render_merged(parts: DataFrame) -> DataFrame:
    """``(article_id, conllu)`` of ``(article_id, b(sent_id, text, lines))``; tokens are sorted one by one only where an article has a number twice."""
    rows = parts.groupBy("article_id").agg(F.array_sort(F.collect_list("b")).alias("bs"))

    def tokens(b: Column) -> Column:
        return F.transform(b["lines"], lambda x, i: F.struct(b["sent_id"].alias("sent_id"), (i + 1).alias("id"), x.alias("line"),
                                                             F.when(i == 0, b["text"]).alias("text")))

    twice = F.size(F.array_distinct("bs.sent_id")) < F.size("bs")
    whole = F.array_join(F.transform("bs", lambda b: F.concat(_head(b), F.array_join(b["lines"], "\n"), F.lit("\n\n"))), "")
    rows = rows.withColumn("ts", F.when(twice, F.array_sort(F.flatten(F.transform("bs", tokens)))))
    return rows.select("article_id", F.when(F.col("ts").isNull(), whole).otherwise(_blocks(F.col("ts"))).alias("conllu"))


def _head(t: Column) -> Column:
    return F.concat(F.lit("# sent_id = "), (t["sent_id"] + 1).cast("string"), F.lit("\n# text = "), F.coalesce(t["text"], F.lit("")), F.lit("\n"))


def _blocks(ts: Column) -> Column:
    """The blocks of an article's sorted ``(sent_id, id, line, text)``."""
    def block_part(t: Column, i: Column) -> Column:
        first = (i == 0) | (F.get(ts, i - 1)["sent_id"] != t["sent_id"])
        last = (i == F.size(ts) - 1) | (F.get(ts, i + 1)["sent_id"] != t["sent_id"])
        return F.concat(F.when(first, _head(t)).otherwise(""), t["line"], F.when(last, "\n\n").otherwise("\n"))

    return F.array_join(F.transform(ts, block_part), "")


def _render_with_text(tokens: DataFrame, include_feats: bool) -> DataFrame:
    token = F.struct("sent_id", "id", token_line(include_feats).alias("line"), "text")
    rows = tokens.groupBy("article_id").agg(F.array_sort(F.collect_list(token)).alias("ts"))
    return rows.select("article_id", _blocks(F.col("ts")).alias("conllu"))


def write_conllu(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store rendered documents as parquet ``(article_id, conllu)``."""
    docs.write.mode(mode).parquet(path)
