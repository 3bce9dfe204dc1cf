"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ans, chat, lattice, manifest, minmax, packing, parttrie, phrases, quality, topk, toxicity, urlrules, warc

MODULES = [chat, packing, warc, ans, urlrules, topk, lattice, toxicity, quality, minmax, phrases, parttrie, manifest]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
