"""Annotation: sentences, the built-in rule annotator (U3) and the pluggable
analyzer slot (U1) that runs an external CoNLL-U producer in Python workers."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.functions.conllu import FIELDS as TOKEN_FIELDS
from corpusflow.schemas import TOKEN_COLUMNS
from corpusflow.session import ship_package, spread

# --- fixed values -----------------------------------------------------------
# Lexicon of the rule annotator: (lang, lowercase form, UPOS).
LEXICON = [
    ("en", "the", "DET"), ("en", "a", "DET"), ("en", "an", "DET"),
    ("fr", "le", "DET"), ("fr", "la", "DET"), ("fr", "les", "DET"),
    ("fr", "un", "DET"), ("fr", "une", "DET"), ("fr", "des", "DET"),
    ("de", "der", "DET"), ("de", "die", "DET"), ("de", "das", "DET"),
    ("de", "ein", "DET"), ("de", "eine", "DET"),
    ("es", "el", "DET"), ("es", "la", "DET"), ("es", "los", "DET"),
    ("es", "las", "DET"), ("es", "un", "DET"), ("es", "una", "DET"),
    ("en", "of", "ADP"), ("en", "in", "ADP"), ("en", "on", "ADP"),
    ("en", "to", "ADP"), ("en", "with", "ADP"), ("en", "from", "ADP"),
    ("en", "by", "ADP"), ("en", "for", "ADP"), ("en", "at", "ADP"),
    ("fr", "de", "ADP"), ("fr", "à", "ADP"), ("fr", "dans", "ADP"),
    ("fr", "sur", "ADP"), ("fr", "pour", "ADP"), ("fr", "avec", "ADP"),
    ("fr", "par", "ADP"),
    ("de", "in", "ADP"), ("de", "mit", "ADP"), ("de", "von", "ADP"),
    ("de", "auf", "ADP"), ("de", "für", "ADP"), ("de", "zu", "ADP"),
    ("es", "de", "ADP"), ("es", "en", "ADP"), ("es", "con", "ADP"),
    ("es", "por", "ADP"), ("es", "para", "ADP"), ("es", "a", "ADP"),
    ("en", "and", "CCONJ"), ("fr", "et", "CCONJ"), ("de", "und", "CCONJ"),
    ("es", "y", "CCONJ"),
    ("en", "is", "VERB"), ("en", "was", "VERB"), ("en", "be", "VERB"),
    ("fr", "est", "VERB"), ("de", "ist", "VERB"), ("es", "es", "VERB"),
]
# ---------------------------------------------------------------------------


def lexicon_df(spark: SparkSession) -> DataFrame:
    """The lexicon as a DataFrame: a fixed list of a few dozen rows, safe to broadcast."""
    return spark.createDataFrame(LEXICON, "lang string, form_lc string, lex_upos string")


def sentences(docs: DataFrame, text_col: str = "text", id_col: str = "article_id",
              upper: str = T.CYRILLIC_UPPER, lower: str = T.CYRILLIC_LOWER,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """T2 as a table: one row per sentence ``(id_col, sent_id, sentence)``.

    Narrow transformation (partitions follow the input); an input with fewer
    splits than cores is spread first (``session.spread``).
    """
    docs = spread(docs.select(id_col, text_col, *keep))
    return docs.select(
        id_col, *keep,
        F.posexplode(T.split_sentences(F.col(text_col), upper, lower)).alias("sent_id", "sentence"),
    )


def annotate_rules(sents: DataFrame, lang_col: str | None = "lang",
                   id_col: str = "article_id", with_text: bool = False) -> DataFrame:
    """The built-in rule annotator, pure Spark SQL.

    Input: sentence rows ``(id_col, sent_id, sentence[, lang])``.
    Output: TOKEN rows.  The only join is with the fixed lexicon, broadcast.
    ``with_text`` adds ``text``: the sentence on its first token, null on the others.
    """
    spark = sents.sparkSession
    toks = sents.select(
        F.col(id_col).alias("article_id"), "sent_id",
        (F.col(lang_col) if lang_col else F.lit(None).cast("string")).alias("lang"),
        *["sentence"] * with_text,
        F.posexplode(T.rule_tokens("sentence")).alias("pos", "form"),
    ).withColumn("id", (F.col("pos") + 1).cast("int")).drop("pos")
    if with_text:
        toks = toks.withColumn("text", F.when(F.col("id") == 1, F.col("sentence"))).drop("sentence")
    toks = toks.withColumn("form_lc", F.lower("form"))
    lex = F.broadcast(lexicon_df(spark))
    toks = toks.join(lex, on=["lang", "form_lc"], how="left")
    return toks.select(
        "article_id", "sent_id", "id", "form",
        F.col("form_lc").alias("lemma"),
        rule_upos(F.col("form"), F.col("id"), F.col("lex_upos")).alias("upos"),
        F.lit("_").alias("xpos"),
        rule_feats(F.col("form")).alias("feats"),
        (F.col("id") - 1).alias("head"),
        F.when(F.col("id") == 1, "ROOT").otherwise("dep").alias("deprel"),
        F.lit("_").alias("deps"),
        F.lit("_").alias("misc"),
        *["text"] * with_text,
    )


def annotate_sentences(sents: DataFrame, lang_col: str | None = "lang", id_col: str = "article_id",
                       fields: tuple[str, ...] = TOKEN_FIELDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """U3 with a sentence as one row: ``(article_id, sent_id, *keep, tokens)``.

    ``tokens`` is an array of structs of ``fields`` in the order of their ids, so the
    token of id i is element i.  Row-local: nothing is exploded, joined or shuffled; the
    lexicon is a constant map by language.  Sentences without a token are left out.
    """
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    known: dict[str, dict[str, str]] = {}
    for language, form, upos in LEXICON:
        known.setdefault(language, {})[form] = upos
    lexicon = F.from_json(F.lit(json.dumps(known)), "map<string,map<string,string>>")

    def token(form: Column, at: Column) -> Column:
        values = {
            "id": (at + 1).cast("int"), "form": form, "lemma": F.lower(form),
            "upos": rule_upos(form, at + 1, F.try_element_at(F.try_element_at(lexicon, lang), F.lower(form))),
            "xpos": F.lit("_"), "feats": rule_feats(form), "head": at.cast("int"),
            "deprel": F.when(at == 0, "ROOT").otherwise("dep"), "deps": F.lit("_"), "misc": F.lit("_")}
        return F.struct(*[values[f].alias(f) for f in fields])

    # tested on the sentence: a filter on the array is pushed below it and would annotate every sentence twice
    return sents.filter(F.col("sentence").rlike(T.TOKEN_REGEX)).select(
        F.col(id_col).alias("article_id"), "sent_id", *keep, F.transform(T.rule_tokens("sentence"), token).alias("tokens"))


def group_sentences(tokens: DataFrame, fields: tuple[str, ...] = TOKEN_FIELDS) -> DataFrame:
    """Sentence rows ``(article_id, sent_id, tokens)`` of a TOKEN table: one exchange, a row bounded by a sentence.

    Ids that are not 1..n within their sentence raise ``TokenIds``.
    """
    rows = tokens.groupBy("article_id", "sent_id").agg(F.array_sort(F.collect_list(F.struct("id", *[f for f in fields if f != "id"]))).alias("tokens"))
    wrong = F.exists(F.transform("tokens", lambda t, i: t["id"] != i + 1), lambda x: x)
    said = F.concat(F.lit("TokenIds: not 1..n in sentence "), F.col("sent_id").cast("string"), F.lit(" of article "), F.col("article_id").cast("string"))
    return rows.withColumn("tokens", F.when(wrong, F.raise_error(said)).otherwise(F.col("tokens")))


def document_sentences(docs: DataFrame, upper: str = T.LATIN_UPPER, lower: str = T.LATIN_LOWER,
                       fields: tuple[str, ...] = TOKEN_FIELDS, with_text: bool = False) -> DataFrame:
    """documents -> annotated sentence rows (``article_id = doc_id + 1``); ``with_text`` adds ``sentence``."""
    d = docs.select((F.col("doc_id") + 1).alias("article_id"), "text", "lang")
    sents = sentences(d, upper=upper, lower=lower, keep=("lang",))
    return annotate_sentences(sents, fields=fields, keep=("sentence",) * with_text)


def rule_upos(form: Column, tok_id: Column, lex_upos: Column) -> Column:
    """First rule that fits: PUNCT, NUM, lexicon, PROPN (capital, not first), NOUN."""
    return (F.when(~form.rlike(r"[\p{L}\p{N}]"), "PUNCT")
            .when(form.rlike(r"^\p{N}+$"), "NUM")
            .when(lex_upos.isNotNull(), lex_upos)
            .when(form.rlike(r"^\p{Lu}") & (tok_id > 1), "PROPN")
            .otherwise("NOUN"))


def rule_feats(form: Column) -> Column:
    return (F.when(~form.rlike(r"[\p{L}\p{N}]") | form.rlike(r"^\p{N}+$"), "_")
            .when(form.rlike(r"^\p{Lu}"), "Case=Up")
            .otherwise("Case=Low"))


def annotate_documents(docs: DataFrame, upper: str = T.LATIN_UPPER,
                       lower: str = T.LATIN_LOWER, with_text: bool = False) -> DataFrame:
    """documents -> sentences -> rule tokens (``article_id = doc_id + 1``)."""
    d = docs.select((F.col("doc_id") + 1).alias("article_id"), "text", "lang")
    return annotate_rules(sentences(d, upper=upper, lower=lower, keep=("lang",)), with_text=with_text)


# --- U1: pluggable analyzer --------------------------------------------------

AnalyzerFactory = Callable[[], Callable[[list[str]], list[str]]]

# Analyzers loaded in this Python worker, keyed by a hash of the pickled factory.
_ANALYZERS: dict[str, Callable[[list[str]], list[str]]] = {}


def _loaded_analyzer(key, factory):
    """The worker's analyzer for ``key``, loading it on first use.

    A module-level function is pickled by reference, so on an executor it
    reads this module's own cache: Python workers are reused across tasks,
    hence the model is loaded once per worker process, not once per task.
    """
    fn = _ANALYZERS.get(key)
    if fn is None:
        fn = factory()
        _ANALYZERS[key] = fn
    return fn


def annotate_with(articles: DataFrame, analyzer_factory: AnalyzerFactory,
                  text_col: str = "text", id_col: str = "article_id") -> DataFrame:
    """Run an external analyzer over article texts in Python workers.

    ``analyzer_factory()`` is called once per Python worker (the model load);
    the analyzer gets a batch of texts and returns one CoNLL-U string per text.
    Output: ``(article_id, conllu)``; parse it with ``sources.conllu.parse_conllu``.
    Arrow batches bound the memory of each call.
    """
    # The cache key is what the factory is, not what it is called: two closures
    # of one maker have one name but not one pickle.
    key = hashlib.sha256(cloudpickle.dumps(analyzer_factory)).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        analyze = _loaded_analyzer(key, analyzer_factory)
        for pdf in batches:
            out = analyze(pdf[text_col].fillna("").tolist())
            yield pd.DataFrame({"article_id": pdf[id_col].astype("int64"), "conllu": out})

    ship_package(articles.sparkSession)
    return spread(articles.select(F.col(id_col), F.col(text_col))).mapInPandas(
        run, "article_id bigint, conllu string")


def process_corpus(articles: DataFrame, analyzer: str | AnalyzerFactory | None = "rules",
                   upper: str = T.LATIN_UPPER, lower: str = T.LATIN_LOWER,
                   out: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """U4: clean every article (T1) and, if an analyzer is given, annotate it.

    ``analyzer="rules"`` uses the built-in rule annotator (pure SQL); a
    callable factory runs through the U1 slot; ``None`` skips annotation (no
    token plan is built at all).  With ``out`` the cleaned texts (K4) and the
    TOKEN table are written under it and read back, so later stages scan them
    instead of re-annotating.  Returns ``(cleaned, tokens or None)``.
    """
    cleaned = articles.select("article_id", T.clean_text("text").alias("cleaned"))
    if analyzer is None:
        tokens = None
    elif analyzer == "rules":
        langs = "lang" if "lang" in articles.columns else None
        keep = ("lang",) if langs else ()
        tokens = annotate_rules(sentences(articles, upper=upper, lower=lower, keep=keep), lang_col=langs)
    else:
        from corpusflow.sources.conllu import parse_conllu
        tokens = parse_conllu(annotate_with(articles, analyzer)).select(*TOKEN_COLUMNS)
    if out is None:
        return cleaned, tokens
    import os

    from corpusflow.sinks.files import write_cleaned
    from corpusflow.sinks.tokens import read_tokens, write_tokens
    spark = articles.sparkSession
    write_cleaned(cleaned, os.path.join(out, "cleaned"))
    if tokens is None:
        return spark.read.parquet(os.path.join(out, "cleaned")), None
    write_tokens(tokens, os.path.join(out, "tokens"))
    return spark.read.parquet(os.path.join(out, "cleaned")), read_tokens(spark, os.path.join(out, "tokens"))
