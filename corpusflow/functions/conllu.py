"""CoNLL-U column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten CoNLL-U fields in file order.
FIELDS = ("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc")

# A token line starts with an integer id; ranges (``1-2``) and empty nodes
# (``1.1``) are skipped.
TOKEN_LINE_REGEX = r"^[0-9]+\t"


def underscore_if_empty(c: Column) -> Column:
    """An empty or missing field is written as ``_``."""
    s = c.cast("string")
    return F.when(s.isNull() | (s == ""), F.lit("_")).otherwise(s)


def parse_feats(feats: Column) -> Column:
    """``A=b|C=d`` -> map; ``_`` or empty -> empty map."""
    return F.when(feats.isNull() | (feats == "_") | (feats == ""),
                  F.create_map().cast("map<string,string>")).otherwise(
        F.str_to_map(feats, F.lit(r"\|"), F.lit("=")))


def is_token_line(line: Column) -> Column:
    """X11: true for CoNLL-U lines that hold a token."""
    return line.rlike(TOKEN_LINE_REGEX)


def token_line(include_feats: bool = True) -> Column:
    """One tab-separated token line from the TOKEN columns."""
    parts = []
    for f in FIELDS:
        c = F.col(f)
        if f == "feats" and not include_feats:
            c = F.lit("_")
        parts.append(underscore_if_empty(c))
    return F.concat_ws("\t", *parts)
