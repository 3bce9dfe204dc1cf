"""Latest rows and set numbering, shared by the loaders.

* ``latest_rows`` keeps the rows with the newest times of each key. Both of
  its aggregates combine map-side, so repeated rows of a hot key collapse
  before the shuffle; there is no window over a key's rows.
* ``with_set_positions`` numbers the distinct values of a key (a dense rank) by
  ranges, of which a key has as many as its number of values needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .heavy import join_one_per_key


def time_order(appts: str = "dv_appts", loadts: str = "dv_loadts") -> Column:
    """A struct that sorts by (applied, load) time with NULL as the newest, as
    the SQL the loader was written for sorts ``DESC`` (NULLS FIRST)."""
    return F.struct(F.col(appts).isNull().alias("no_appts"), F.col(appts).alias("appts"),
                    F.col(loadts).isNull().alias("no_loadts"), F.col(loadts).alias("loadts"))


def latest_rows(df: DataFrame, keys: list[str], values: list[str], sketched: DataFrame | None = None) -> DataFrame:
    """Distinct (keys, values) whose newest time is the newest of the keys.

    Keys that are heavy in ``sketched`` are spread by their last value. Ties all stay: several values may share the newest times and all of them
    count as current. Rows with a NULL key are left out: callers compare keys by
    plain equality, which NULL never meets.
    """
    per_value = df.groupBy(*keys, *values).agg(F.max(time_order()).alias("_at"))
    per_key = per_value.groupBy(*keys).agg(F.max("_at").alias("_newest"))
    if sketched is None:
        both = per_value.join(per_key, keys)
    else:
        both = join_one_per_key(per_value, per_key, keys, values[-1], sketched)
    return both.where(F.col("_at") == F.col("_newest")).select(*keys, *values)


def with_set_positions(rows: DataFrame, keys: list[str], value: str, count: str, in_range: int = 1 << 14) -> DataFrame:
    """``rows``, one per (``keys``, ``value``), with ``dv_subseq``, the rank of ``value`` within ``keys``, in place
    of column ``count``, the number of values of the keys.

    ``value`` must be a hex digest, so equal prefixes cut its values into even ranges. A
    key with more than ``in_range`` values is cut by as many digits as its count needs, at
    most ``in_range`` expected in a range; ranges are ranked apart, and a range's offset is the sum of the
    ranges before it. Other keys are one range with offset 0. So no task ranks much more than
    ``in_range`` values of a key.
    """
    digits = F.when(F.col(count) > in_range, F.ceil(F.log(16.0, F.col(count) / in_range))).otherwise(0).cast("int")
    ranged = rows.withColumn("_digits", digits).withColumn("_range", F.expr(f"substring({value}, 1, _digits)"))
    ranked = ranged.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(value)))
    # Only keys of several ranges have offsets: few rows are counted a second time.
    sizes = ranged.where("_digits > 0").groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranked.join(offsets, [*keys, "_range"], "left").withColumn(
        "dv_subseq", (F.coalesce("_off", F.lit(0)) + F.col("_pos")).cast("int")
    ).drop("_digits", "_range", "_pos", "_off", count)
