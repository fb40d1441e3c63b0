"""Queries of the encoding, packing and judging operators (4, 5, 6)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import documents
from corpusflow.llm.packing import pack
from corpusflow.llm.piece_scan import encode
from corpusflow.llm.registry import register
from corpusflow.llm.weak_supervision import quality

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@register("op5_swap_packing")
def op5_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces, packed into sequences of at most 4096 ids."""
    return pack(documents(spark, sf_dir), TOKENIZER, size=4096, end_id=1)


@register("op6_weak_supervision")
def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether the base rules and the estimated quality keep it."""
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@register("op4_piece_scan")
def op4_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, giant ones chunk by chunk, and what their ids decode to."""
    return encode(documents(spark, sf_dir), PIECES).select(
        "doc_id", "chunk", "start", "n_ids", "ids_crc32", "score", F.sha2("text", 256).alias("text_sha256"))
