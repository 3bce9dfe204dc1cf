"""Effectivity satellite: open and close the validity period of link rows.

For a link and its *driving* hub key(s), each run compares the relations in
the current source snapshot with the open effectivity records:

* ``open``   — a relation in the source that has no open record: start at
  the applied time, end at the high date;
* ``closed`` — an open record whose driving key is still in the source but
  whose full relation is not (the driver moved to another partner): the
  start is kept, the end becomes the applied time.

A relation whose driving key vanished from the source altogether stays open.
The result is appended; rerunning the same snapshot adds nothing.

Digests go packed through all of it. Open records and staged relations are dealt
by the link key once and meet in one full join; what only one of them has, opened and
ended relations, meets the drivers that are still there in one more. The latest records are
found where they lie: a relation has as many records as runs that opened or closed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hashdiff, high_date, pack, text_columns, unpack
from ..functions.meta import ENDTS, HASHDIFF, STARTTS
from ..functions.prune import no_rows
from ..functions.windows import time_order
from ..run import Run
from ..spec import Effectivity, Link
from .load import first_source_wins

EFFECTIVITY_META = ["dv_recsrc", "dv_tenant", "dv_bkeycode"]


def effectivity_columns(link: Link) -> list[str]:
    return [link.hk, STARTTS, ENDTS, HASHDIFF, "dv_loadts", "dv_appts", *EFFECTIVITY_META, "dv_taskid"]


def _period_hash(start, end):
    return hashdiff([start.cast("string"), end.cast("string")])


def _distinct_by(rows: DataFrame, key: str) -> DataFrame:
    """Distinct ``rows``, dealt by ``key`` alone: copies collapse map-side, and a join on the key moves none again."""
    values = rows.groupBy(key).agg(F.collect_set(F.struct(*[c for c in rows.columns if c != key])).alias("_values"))
    return values.select(key, F.explode("_values").alias("_value")).select(key, "_value.*").select(*rows.columns)


def open_records(target: DataFrame, link_rows: DataFrame, link: Link, drivers: list[str]) -> DataFrame:
    """Latest record per link key that is still open, with its driving key(s)
    taken from the link table."""
    value = [STARTTS, ENDTS, *EFFECTIVITY_META]
    rows = target.where(F.col(link.hk).isNotNull()).select(link.hk, *value, time_order().alias("_at")).repartition(link.hk)
    # Equal records count once, by their newest time; one sort serves both windows.
    copies = Window.partitionBy(link.hk, *value).orderBy(F.desc("_at"))
    rows = rows.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1")
    rows = rows.withColumn("_newest", F.max("_at").over(Window.partitionBy(link.hk)))
    latest = rows.where(F.col("_at") == F.col("_newest")).select(link.hk, *value)
    still_open = latest.where(F.col(ENDTS) == high_date()).drop(ENDTS)
    keys = _distinct_by(link_rows.select(link.hk, *drivers), link.hk)
    return still_open.join(keys, link.hk)


def effectivity_delta(stages, target: DataFrame | None, link_rows: DataFrame | None, eff: Effectivity,
                      link: Link, run: Run) -> DataFrame:
    """Rows to append to the effectivity satellite ``eff`` of ``link``.

    ``stages``: staged link rows of the current source snapshot (one or more
    sources); ``target``: the effectivity table (None on the first run);
    ``link_rows``: the link table, for the driving keys of open records.
    """
    stages = stages if isinstance(stages, (list, tuple)) else [stages]
    drivers = list(eff.drivers)
    task = run.load_task(eff.name)
    applied = run.applied_ts_col()
    if target is not None and link_rows is None:
        raise ValueError(f"effectivity {eff.name}: the link table is needed to find driving keys")
    if target is not None and no_rows(target):
        target = None
    # Digests go packed through distincts and joins, where every side has them as text.
    keyed = [*stages, *([] if target is None else [link_rows])]
    digests = [c for c in dict.fromkeys([link.hk, *drivers]) if all(text_columns(d, [c]) for d in keyed)]
    if target is not None and not text_columns(target, [link.hk]):
        digests = [c for c in digests if c != link.hk]
    # Already one row per link key: the link hash covers every hub-key part
    # (the driver's included) and first_source_wins keeps one source per key.
    staged_rows = [pack(s.select(link.hk, *drivers, *EFFECTIVITY_META), digests) for s in stages]
    relations = first_source_wins([_distinct_by(s, link.hk) for s in staged_rows], [link.hk])
    if target is None:
        rows = relations.withColumn(STARTTS, F.lit(None).cast("timestamp_ntz"))
        is_new = F.lit(True)
    else:
        own = [c for c in digests if c == link.hk]
        current = open_records(pack(target.select(link.hk, STARTTS, ENDTS, *EFFECTIVITY_META, "dv_appts", "dv_loadts"), own),
                               pack(link_rows.select(link.hk, *drivers), digests), link, drivers)
        carried = [*drivers, *EFFECTIVITY_META]
        staged = relations.select(link.hk, F.struct(*carried).alias("_staged"))
        opened = current.select(link.hk, STARTTS, F.struct(*carried).alias("_open"))
        # Of either side, what the other one lacks.
        rows = opened.join(staged, link.hk, "full").where("_staged IS NULL OR _open IS NULL").select(
            link.hk, STARTTS, F.col("_open").isNull().alias("_new"), F.coalesce("_open", "_staged").alias("_row")
        ).select(link.hk, STARTTS, "_new", "_row.*")
        # A driver with very many relations brings only those that began or ended to the join on the driver.
        # One source's drivers are those of its rows: they needn't be dealt by the link key first.
        here = (relations if len(stages) > 1 else staged_rows[0]).select(*drivers).distinct().withColumn("_here", F.lit(True))
        rows = rows.join(here, drivers, "left").where("_new OR _here")
        is_new = F.col("_new")
    start = F.when(is_new, applied).otherwise(F.col(STARTTS))
    end = F.when(is_new, high_date()).otherwise(applied)
    return unpack(rows, [link.hk] if link.hk in digests else []).select(
        link.hk,
        start.alias(STARTTS),
        end.alias(ENDTS),
        F.when(is_new, _period_hash(applied, high_date())).otherwise(_period_hash(F.col(STARTTS), applied)).alias(HASHDIFF),
        run.load_ts_col().alias("dv_loadts"),
        applied.alias("dv_appts"),
        *EFFECTIVITY_META,
        F.lit(task).alias("dv_taskid"),
    )
