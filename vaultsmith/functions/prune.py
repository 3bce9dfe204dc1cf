"""Drop target rows that no staged key can meet, before they are shuffled.

The staged keys are hashed into a bitmap of fixed size, built by a map-side combined
``bit_or`` and held by the plan as a scalar subquery. A target row is kept if its key's bit is set:
all rows of staged keys, and of the others the share of bits that is set (with n
distinct staged keys about n / BITS). If more than half of the bits are set, the
bitmap is dropped and every row stays: the join is then a plain one. The rows that
a key join sees are the same in either case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a bitmap: 1 MB, 8.4 million bits.
WORDS = 1 << 17
#: Target tables under this size are shuffled as they are: building the bitmap would cost more.
PRUNE_FROM = 256 << 20


def _word_and_bit(key: str, words: int) -> tuple[Column, Column]:
    slot = F.pmod(F.xxhash64(key), F.lit(words * 64))
    return F.shiftright(slot, 6).cast("int"), (slot % 64).cast("int")


def key_bitmap(staged: DataFrame, key: str, words: int = WORDS) -> Column:
    """The words of the bitmap of the keys, as a subquery; NULL if over half full."""
    word, bit = _word_and_bit(key, words)
    bits = staged.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    every = staged.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = bits.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    whole = dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"), F.sum(F.bit_count("bits")).alias("n"))
    return whole.select(F.when(F.col("n") * 2 <= words * 64, F.transform("w", lambda x: x["bits"])).alias("words")).scalar()


def table_bytes(df: DataFrame) -> int:
    """The size of the table or files that ``df`` reads, as the optimizer knows it; -1 if ``df`` is more than a
    selection from one table."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size, node = plan.stats().sizeInBytes(), plan
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return int(str(size)) if node.children().size() == 0 else -1


def no_rows(df: DataFrame) -> bool:
    """Whether the one table or file that ``df`` selects from has no rows, as before a first load; False for
    anything derived, which would have to be computed for the answer."""
    return 0 <= table_bytes(df) < PRUNE_FROM and df.isEmpty()


def pruned(target: DataFrame, staged: list[DataFrame], key: str, words: int = WORDS, prune_from: int | None = None) -> DataFrame:
    """``target`` without most of the rows whose ``key`` none of the ``staged`` frames has (rows with a NULL key go too)."""
    if table_bytes(target) < (PRUNE_FROM if prune_from is None else prune_from):
        return target
    keys = staged[0].select(key)
    for s in staged[1:]:
        keys = keys.unionByName(s.select(key))
    word, bit = _word_and_bit(key, words)
    has = F.getbit(F.element_at(key_bitmap(keys.where(F.col(key).isNotNull()), key, words), word + 1), bit)
    return target.where(F.col(key).isNotNull() & (F.coalesce(has, F.lit(1)) == 1))
