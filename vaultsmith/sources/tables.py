"""Scans: source tables, virtual (SQL) sources, vault targets, metadata.

Every reader returns a lazy DataFrame; Catalyst pushes the loaders' column
selection and any filter of a virtual source down to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SourceResolver = Callable[[str], DataFrame]


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual name of a column, matched case-insensitively (unquoted SQL
    identifiers are case-insensitive), or None."""
    lowered = name.lower()
    for c in df.columns:
        if c.lower() == lowered:
            return c
    return None


def source_columns(df: DataFrame) -> list[str]:
    """Column names of a source (replaces an information_schema lookup)."""
    return list(df.columns)


def catalog_sources(spark: SparkSession, schema: str) -> SourceResolver:
    """Resolve source names to catalog tables ``<schema>.<name>``."""
    return lambda name: spark.table(f"{schema}.{name}")


def parquet_sources(spark: SparkSession, root: str) -> SourceResolver:
    """Resolve source names to ``<root>/<name>.parquet`` (file or folder)."""
    return lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def mapping_sources(frames: Mapping[str, DataFrame]) -> SourceResolver:
    """Resolve source names from a dict of prepared DataFrames."""
    return lambda name: frames[name]


def jdbc_sources(spark: SparkSession, url: str, schema: str, partitioning: Mapping[str, dict],
                 properties: dict | None = None) -> SourceResolver:
    """Resolve source names to JDBC tables (``schema.name``); filters and the
    selected columns are pushed into the database query by Spark.

    ``partitioning`` gives per table either ``column``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, or ``predicates``: without them one
    task would read the whole table, so a table that is missing is an error.
    """
    props = dict(properties or {})

    def read(name: str) -> DataFrame:
        how = partitioning.get(name)
        if not how or not (how.get("predicates") or {"column", "lowerBound", "upperBound", "numPartitions"} <= set(how)):
            raise ValueError(f"JDBC table {name}: give a partition column with bounds and number, or predicates")
        return spark.read.jdbc(url, f"{schema}.{name}", properties=props, **how)

    return read


def virtual_source(spark: SparkSession, sql: str) -> DataFrame:
    """A business-vault source: any Spark SQL text, used as a derived table.

    Trailing semicolons are dropped so a copied statement still parses.
    """
    return spark.sql(sql.strip().rstrip(";"))


def register_views(spark: SparkSession, resolver: SourceResolver, names: list[str]) -> None:
    """Expose sources as temporary views so virtual SQL can name them."""
    for name in names:
        resolver(name).createOrReplaceTempView(name)


def vault_table(spark: SparkSession, name: str, columns: list[str] | None = None, before=None) -> DataFrame | None:
    """A vault target, pruned to the columns a loader compares; None if the
    table does not exist yet (first load). ``before``: a run whose own rows are
    left out (its partition is not read)."""
    if not spark.catalog.tableExists(name):
        return None
    # Vault tables are appended by other jobs and sessions (a streaming
    # micro-batch runs in a cloned session): drop any cached file listing.
    spark.catalog.refreshTable(name)
    df = spark.table(name)
    if before is not None:
        df = df.where(~F.col("dv_loadts").eqNullSafe(before.load_ts_col()))
    return df.select(*columns) if columns else df


def list_vault_tables(spark: SparkSession, schema: str) -> list[str]:
    """Names of the tables in a vault schema (the session's temporary views,
    which the catalog lists under every schema, are left out)."""
    if not spark.catalog.databaseExists(schema):
        return []
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
