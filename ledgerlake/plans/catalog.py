"""Named queries over the driver tables, each with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``; it reads the driver tables (through
the staged fixture tables of ``ledgerlake.fixtures``) and runs one or more package
operators over **all** rows.  ``sql`` states the same result in SQL for DuckDB over
the raw driver tables; ``None`` marks a query that SQL cannot state (streaming
jobs), which the driver then checks by row count only.

Output money columns are ``decimal(38,6)`` (or ``ROUND(.., 2)``) on both sides;
ratios are doubles computed from the same decimals in the same order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: tuple[str, ...]
    headline: bool = False


CATALOG: dict[str, Query] = {}


def query(name: str, ids: tuple[str, ...], sql: str | None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(name, fn, sql, ids, headline)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries, then return the catalog."""
    from . import (  # noqa: F401  (registration)
        queries_billing,
        queries_files,
        queries_ops,
        queries_reports,
        queries_stored,
        queries_stream,
    )

    return CATALOG
