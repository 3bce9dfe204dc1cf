"""Keys that hold a large share of the rows, and joins that spread them.

The heavy keys of a table are found by a mergeable sketch of the most frequent key hashes
(``approx_top_k``): it is combined map-side, has a fixed size, and tracks every key with more than
one in ``TRACKED`` rows. At most ``HEAVIEST`` hashes come out of it, as one array that a
plan holds as a scalar subquery, so nothing is broadcast by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVIEST = 64
TRACKED = 1024
#: A key is heavy if it holds more than one in SHARE rows.
SHARE = 64
#: A heavy key's rows are dealt to so many parts.
SALTS = 64
_SALT = "_salt"


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_hashes(rows: DataFrame, keys: list[str]) -> Column:
    """The hashes of the heavy keys of ``rows``: one array, as a subquery."""
    top = rows.select(key_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {HEAVIEST}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    over = F.filter("top", lambda x: x["count"] * SHARE > F.col("n"))
    return top.select(F.transform(over, lambda x: x["item"]).alias("hashes")).scalar()


def is_heavy(sketched: DataFrame, keys: list[str]) -> Column:
    """Whether a row's key is heavy in ``sketched``; never NULL."""
    return F.coalesce(F.array_contains(heavy_hashes(sketched, keys), key_hash(keys)), F.lit(False))


def split(rows: DataFrame, heavy: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` that are not heavy, and those that are. The flag is a generated column, which filters are not pushed
    beneath: else each of the two would compute and shuffle a derived table anew, under conditions that
    grow with every load it comes from."""
    flagged = rows.select("*", F.explode(F.array(heavy)).alias("_heavy"))
    return flagged.where(~F.col("_heavy")).drop("_heavy"), flagged.where("_heavy").drop("_heavy")


def join_one_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], spread: str,
                     sketched: DataFrame) -> DataFrame:
    """``rows`` joined with ``per_key``, which has one row per key.

    Rows of a key that is heavy in ``sketched`` are dealt by the hash of column ``spread``; its
    one row goes to all parts. The other keys join as usual. NULL keys meet nothing.
    """
    heavy = is_heavy(sketched, keys)
    part = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    # Never NULL, and Spark shall see it: else it tests the salt again in every scan.
    dealt = rows.withColumn(_SALT, F.coalesce(F.when(heavy, part), F.lit(0)))
    every = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(per_key.withColumn(_SALT, F.explode(every)), [*keys, _SALT]).drop(_SALT)
