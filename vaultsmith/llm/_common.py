"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Fixed value: the white space of the word rules (space, and tab to carriage return).
SPACE_CLASS = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared checkpoint folder and read it back.

    Cuts the lineage with replicated, column-pruned storage: an executor lost later
    costs only the task that was reading, never the work that made the table.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """``small`` marked for broadcast if its counted rows are within ``max_rows``.

    Beyond that it is returned unmarked and the join stays shuffled, where AQE splits
    hot keys. ``small`` should come from ``keep`` so that counting it is cheap.
    """
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also when used inside lambdas."""
    return F.transform(F.array(value), body)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
