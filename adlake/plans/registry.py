"""Registry of named queries (Spark callables) and their SQL oracles."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

CATALOG_MODULES = (
    "adlake.plans.catalog_unify",
    "adlake.plans.catalog_lake",
    "adlake.plans.catalog_nested",
    "adlake.plans.catalog_assets",
    "adlake.plans.catalog_scope",
    "adlake.plans.catalog_pages",
    "adlake.plans.catalog_telemetry",
    "adlake.plans.catalog_metrics",
    "adlake.plans.catalog_streams",
)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an
    optional DuckDB-runnable oracle ``sql``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for mod in CATALOG_MODULES:
        importlib.import_module(mod)
