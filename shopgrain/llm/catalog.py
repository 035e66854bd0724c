"""All registered queries of this package."""

from shopgrain.llm import (  # noqa: F401
    decontamination,
    html,
    jaccard,
    language,
    neighbours,
    packing,
    quality,
    scoring,
    secrets,
    sharding,
    toxicity,
    trie,
    whitening,
)
from shopgrain.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
