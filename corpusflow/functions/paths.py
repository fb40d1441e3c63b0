"""Corpus file names: article id from a name (X6), artifact names (K6) and the
recognised-file filter (P18)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Artifact kinds and their file-name suffixes: N_raw.txt, N_meta.json,
# N_cleaned.txt, N_udpipe.conllu.
ARTIFACT_SUFFIX = {
    "raw": "_raw.txt",
    "meta": "_meta.json",
    "cleaned": "_cleaned.txt",
    "udpipe": "_udpipe.conllu",
}
# Recognised corpus file names (full match; images are not corpus files).
CORPUS_FILE_REGEX = r"^[0-9]+_(raw\.txt|meta\.json|cleaned\.txt|udpipe\.conllu)$"
# ---------------------------------------------------------------------------


def file_stem(name: Column) -> Column:
    """File name without its last suffix (``12_raw.txt`` -> ``12_raw``)."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def article_id_from_name(name: Column) -> Column:
    """The digits before the first ``_`` of the stem, as BIGINT (null if
    they are not a number)."""
    return F.split_part(file_stem(name), F.lit("_"), F.lit(1)).try_cast("bigint")


def file_name_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def artifact_name(article_id: Column, kind: Column) -> Column:
    """K6: ``<id><suffix>`` for a known kind; an unknown kind raises."""
    suffixes = F.create_map(*[x for k, v in ARTIFACT_SUFFIX.items() for x in (F.lit(k), F.lit(v))])
    suffix = F.element_at(suffixes, kind)
    return F.when(suffix.isNull(),
                  F.raise_error(F.concat(F.lit("unknown artifact kind: "), kind))
                  ).otherwise(F.concat(article_id.cast("string"), suffix))


def is_corpus_file(name: Column) -> Column:
    """A recognised corpus file name (full match)."""
    return name.rlike(CORPUS_FILE_REGEX)


def corpus_file_kind(name: Column) -> Column:
    """``raw`` / ``meta`` / ``cleaned`` / ``udpipe`` for recognised names, else null."""
    return F.when(is_corpus_file(name),
                  F.regexp_extract(name, r"^[0-9]+_([a-z]+)\.", 1))
