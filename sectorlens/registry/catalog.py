"""All registered queries with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from . import retrieval_queries, rollup_queries, stat_queries, text_queries

_MODULES = (stat_queries, text_queries, rollup_queries, retrieval_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text for module in _MODULES for name, text in module.ORACLES.items()}
