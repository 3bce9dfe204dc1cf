"""Writers: schemas, table DDL from the model, stage overwrite, delta append.

Vault tables are append-only Parquet tables. Text columns are
``VARCHAR(256)``, so Spark rejects a value that is too long on write, as the
database the model was written for does. Optionally a table is bucketed by
its hash key: later loads then read the (ever-growing) target already
partitioned by the join key and shuffle only the new, staged side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.keys import MAX_VARCHAR
from ..functions.meta import ENDTS, HASHDIFF, STARTTS, SUBSEQ
from ..spec import Effectivity, Hub, Link, Sat


#: All rows that a run appends to a table have the run's load time, so it names the run's batch.
BATCH = "dv_loadts"
#: Hex digests fill most of a table; unlike Spark's default, this codec halves them.
COMPRESSION = "zstd"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _varchar(width: int = MAX_VARCHAR) -> str:
    return f"VARCHAR({width})"


def _meta(width: int) -> list[tuple[str, str]]:
    return [("dv_loadts", "TIMESTAMP_NTZ"), ("dv_appts", "TIMESTAMP_NTZ"), ("dv_recsrc", _varchar(width)),
            ("dv_tenant", _varchar(width)), ("dv_bkeycode", _varchar(width))]


def table_columns(entity, width: int = MAX_VARCHAR, link: Link | None = None) -> list[tuple[str, str]]:
    """(name, SQL type) of a vault or stage table, in insert order."""
    v = _varchar(width)
    task = [("dv_taskid", v)]
    if isinstance(entity, Hub):
        return [(entity.hk, v), (entity.bk, v), *_meta(width), *task]
    if isinstance(entity, Link):
        return [(entity.hk, v), *[(k, v) for k in entity.hks], *[(c, v) for c in entity.cks.values()],
                *_meta(width), *task]
    if isinstance(entity, Sat):
        cols = [(entity.hk, v), *[(c, v) for c in entity.cks.values()], *[(a, v) for a in entity.attrs],
                (HASHDIFF, v), *_meta(width)]
        if entity.multiactive and not entity.cks:
            cols.append((SUBSEQ, "INT"))
        return [*cols, *task]
    if isinstance(entity, Effectivity):
        if link is None:
            raise ValueError("effectivity tables need their link")
        return [(link.hk, v), (STARTTS, "TIMESTAMP_NTZ"), (ENDTS, "TIMESTAMP_NTZ"), (HASHDIFF, v),
                *_meta(width), *task]
    raise TypeError(f"unknown entity {entity!r}")


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def ensure_table(spark: SparkSession, name: str, columns: list[tuple[str, str]], bucket_key: str | None = None,
                 buckets: int | None = None, fmt: str = "parquet", location: str | None = None,
                 by_run: bool = False) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an existing table is left as it is.

    With ``by_run`` the table has a partition per load time, for ``write_batch``
    (``dv_loadts`` is its last column then)."""
    cols = ", ".join(f"{c} {t}" for c, t in columns)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}"
    if fmt == "parquet":
        ddl += f" OPTIONS (compression '{COMPRESSION}')"
    if by_run:
        ddl += f" PARTITIONED BY ({BATCH})"
    if buckets and bucket_key:
        ddl += f" CLUSTERED BY ({bucket_key}) INTO {int(buckets)} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a table, or None."""
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in found:
        return None
    return int(found["Num Buckets"]), [c.strip(" `[]") for c in found["Bucket Columns"].split(",")]


def append(df: DataFrame, name: str) -> None:
    """Append rows (``INSERT INTO``), columns matched to the table by name.

    For a table with buckets the rows are rebalanced first, by the bucket key:
    each bucket is then written by one task (a hot one by several, which AQE
    splits), instead of every task writing a file for every bucket. Other tables take
    the partitions as the load leaves them, which AQE has sized: rows are not shuffled again.
    """
    _rebalanced(df, name).write.insertInto(name)


def _rebalanced(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    buckets = bucketing(spark, name)
    return rows.hint("rebalance", buckets[0], *buckets[1]) if buckets else rows


def write_batch(df: DataFrame, name: str) -> None:
    """Write a run's rows as the table's partition of the run, in place of those an
    earlier attempt of the run left there.

    ``df`` must be compared with the table without that partition (``vault_table(..., before=run)``), so that
    a repeated run finds the same rows again. The new files are moved in when the job commits; a run that
    dies before leaves the old ones. The session must overwrite partitions dynamically (``by_partition``).
    """
    if df.sparkSession.conf.get(OVERWRITE_MODE).lower() != "dynamic":
        raise ValueError(f"set {OVERWRITE_MODE} to dynamic: otherwise all other runs' rows would be overwritten")
    _rebalanced(df, name).write.insertInto(name, overwrite=True)


def by_partition(spark: SparkSession) -> None:
    """Overwrites replace only the partitions they bring rows for."""
    spark.conf.set(OVERWRITE_MODE, "dynamic")


def compact(spark: SparkSession, name: str, location: str, key: str | None = None, files: int | None = None) -> str:
    """Rewrite an append-only table into one sorted file per bucket (or ``files`` files) at ``location``
    and switch the table to it. Returns the folder it left.

    A reader that has started keeps reading the old files, which stay where they are; one that starts after
    the switch reads the new ones. Rows that a load appends meanwhile would be missing, so the switch
    is refused if the table's files have changed; compact between loads.
    """
    spark.catalog.refreshTable(name)
    table = spark.table(name)
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "# Partition Information" in info:
        raise ValueError(f"{name} is partitioned: a run's batch is one file per bucket already")
    before = sorted(table.inputFiles())
    buckets = bucketing(spark, name)
    n, keys = buckets if buckets else (files or 1, [key or table.columns[0]])
    copy = f"{name}__compacted"
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    layout = f" CLUSTERED BY ({', '.join(keys)}) INTO {n} BUCKETS" if buckets else ""
    columns = spark.sql(f"DESCRIBE {name}").collect()
    spark.sql(f"CREATE TABLE {copy} ({', '.join(f'{c.col_name} {c.data_type}' for c in columns)}) USING parquet{layout} LOCATION '{location}'")
    # Buckets are hash partitions of the same hash, so every task writes one bucket. The files are read as such:
    # over a bucketed scan the planner would drop the repartition, and then not use the buckets.
    rows = spark.read.schema(table.schema).parquet(info["Location"])
    rows.repartition(n, *keys).sortWithinPartitions(*keys).write.insertInto(copy)
    spark.catalog.refreshTable(name)
    if sorted(spark.table(name).inputFiles()) != before:
        raise RuntimeError(f"{name} was written to while it was compacted: not switched")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE {copy}")  # external: its files are the table's now
    return info["Location"]


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Replace a stage table's rows (create + truncate + insert) and return
    the written table, which cuts the lineage for every load that reads it."""
    spark = df.sparkSession
    df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION).saveAsTable(name)
    return spark.table(name)
