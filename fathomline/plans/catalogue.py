"""All registered queries of the engine."""

from __future__ import annotations

from fathomline.plans import chunk_queries, graph_queries, source_queries, store_queries, stream_queries, text_queries, vector_queries  # noqa: F401
from fathomline.plans.registered import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
