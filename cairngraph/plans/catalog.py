"""All registered queries."""

from __future__ import annotations

from cairngraph.plans import (  # noqa: F401
    code_queries,
    graph_queries,
    scalar_queries,
    search_queries,
    source_queries,
    table_queries,
)
from cairngraph.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
