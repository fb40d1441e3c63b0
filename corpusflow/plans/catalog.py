"""Import every query module so that the registry is complete."""

from corpusflow.plans import (  # noqa: F401
    analyzer_queries,
    conllu_queries,
    corpus_queries,
    crawl_queries,
    date_queries,
    graph_queries,
    html_queries,
    link_queries,
    text_queries,
)
from corpusflow.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
