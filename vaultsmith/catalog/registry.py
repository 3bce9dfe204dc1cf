"""Registry of checked queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a Spark query under ``name`` with its oracle SQL (if any)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def _load_all() -> None:
    from . import (  # noqa: F401
        bv_queries,
        effectivity_queries,
        hot_key_queries,
        hub_queries,
        link_queries,
        many_source_queries,
        roundtrip_queries,
        run_queries,
        sat_queries,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
