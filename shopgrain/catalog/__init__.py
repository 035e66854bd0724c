"""All registered queries with their comparison SQL."""

from shopgrain.catalog import changes, models, quality, relations, reports  # noqa: F401
from shopgrain.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
