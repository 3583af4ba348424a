"""All registered queries of the span operators, and their SQL twins."""

from __future__ import annotations

from . import corpus_queries, review_queries, service_queries, span_queries

FLAGSHIP = "alignment_outcomes"
MODULES = [span_queries, corpus_queries, review_queries, service_queries]


def queries():
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
