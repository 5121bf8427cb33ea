"""Every operator as a named query over the given tables, most with an equivalent SQL text."""

from __future__ import annotations

from ledgerlift.catalog import feature_queries, model_queries, profile_queries, score_queries, source_queries
from ledgerlift.catalog.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "feature_queries",
    "model_queries",
    "profile_queries",
    "score_queries",
    "source_queries",
]
