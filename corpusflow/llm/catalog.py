"""Import every query module of the subpackage so that its registry is complete."""

from corpusflow.llm import queries_dedup, queries_manifest, queries_phrases, queries_quality, queries_scans, queries_warc  # noqa: F401
from corpusflow.llm.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
