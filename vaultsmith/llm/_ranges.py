"""Ordered ranges of nearly equal weight, and positions in their order.

A range partitioner samples anew in every job. Here the range bounds are quantiles of a
long key, computed once and then fixed, so the range of a row is a function of its key
alone: a retried task deals its rows out exactly as before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import partitions

#: Ranges per shuffle partition: hashing several to each evens them out.
RANGES_PER_PARTITION = 4


def bounds(df: DataFrame, key: str) -> list[int]:
    """At most RANGES_PER_PARTITION * shuffle partitions - 1 ascending bounds of ``key``."""
    n = RANGES_PER_PARTITION * partitions(df.sparkSession)
    shares = [i / n for i in range(1, n)]
    found = df.agg(F.percentile_approx(key, shares, 20 * n).alias("q")).first()["q"] or []
    return sorted(set(found))


def range_of(key: str, cuts: list[int]) -> Column:
    """Number of the range that holds ``key`` (0 for null)."""
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def ranged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(np.searchsorted(edges, keys.to_numpy(np.int64), side="left").astype("int32"))

    return ranged(F.coalesce(F.col(key), F.lit(-(2**63))))


def starts(df: DataFrame, range_col: str, weight: str) -> dict[int, int]:
    """Sum of ``weight`` over all ranges before each range (a few numbers per partition)."""
    sums = df.groupBy(range_col).agg(F.sum(weight).alias("w")).collect()
    out, total = {}, 0
    for r in sorted(sums, key=lambda r: r[range_col]):
        out[r[range_col]] = total
        total += r["w"]
    return out


def in_order(df: DataFrame, range_col: str, *order: str) -> DataFrame:
    """Every range whole in one partition, rows sorted by (range, ``order``)."""
    return df.repartition(partitions(df.sparkSession), range_col).sortWithinPartitions(range_col, *order)
