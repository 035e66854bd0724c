"""The registered queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopgrain.catalog.duck import with_fragments
from shopgrain.sources.raw import RawTables
from shopgrain.sources.warehouse import raw_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(name: str, build: Callable[[RawTables], DataFrame], sql: str | None = None) -> None:
    """Register a query over the raw tables."""
    add_on_folder(name, lambda spark, folder: build(raw_tables(spark, folder)), sql)


def add_on_folder(name: str, build: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = build
    if sql is not None:
        ORACLE[name] = with_fragments(sql)
