"""All registered queries of this subpackage."""

from __future__ import annotations

from cairngraph.llm import (  # noqa: F401
    ann,
    bpe,
    hard_negatives,
    jaccard,
    language,
    near_vectors,
    packing,
    perplexity,
    quality_rules,
    secrets,
    spelling,
    substring,
    toxicity,
)
from cairngraph.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
