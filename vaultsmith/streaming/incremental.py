"""Incremental vault loads driven by Structured Streaming.

A source that grows by files (or any streaming source) is loaded one
micro-batch at a time with ``foreachBatch``: each batch is staged and its
delta appended with exactly the batch loaders. Vault loads are insert-only
and compare with the target, so a micro-batch that is replayed after a
failure appends nothing it already appended: at-least-once delivery gives
exactly-once vault contents (child-key rows with a NULL business-vault child
key excepted, which never match by design).
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.meta import HASHDIFF, SUBSEQ
from ..operators.load import hub_delta, link_delta, sat_delta
from ..operators.stage import stage
from ..run import Run
from ..session import tune
from ..sinks.tables import append, ensure_table, table_columns
from ..sources.tables import vault_table
from ..spec import Hub, Link, Sat, Source

RunFactory = Callable[[int], Run]


def _now_run(epoch_id: int) -> Run:
    return Run(load_ts=_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0))


def _compare_columns(entity, run: Run) -> list[str]:
    if isinstance(entity, Hub):
        return [entity.hk]
    if isinstance(entity, Link):
        return [entity.hk, *entity.cks.values()] if run.strict else [entity.hk]
    cols = [entity.hk, *entity.cks.values(), HASHDIFF, "dv_appts", "dv_loadts"]
    return [*cols, SUBSEQ] if entity.multiactive and not entity.cks else cols


def load_batch(batch: DataFrame, entity: Hub | Link | Sat, src: Source, table: str, run: Run,
               business: bool = False) -> None:
    """Stage one batch of ``src`` rows and append what ``table`` lacks."""
    spark = batch.sparkSession
    staged = stage(batch, entity, src, run, business)
    target = vault_table(spark, table, _compare_columns(entity, run))
    if isinstance(entity, Hub):
        delta = hub_delta(staged, target, entity, run)
    elif isinstance(entity, Link):
        delta = link_delta(staged, target, entity, run)
    else:
        delta = sat_delta(staged, target, entity, run)
    append(delta, table)


def start_incremental_load(spark: SparkSession, source_stream: DataFrame, entity: Hub | Link | Sat,
                           src: Source, table: str, checkpoint_location: str | None = None,
                           run_factory: RunFactory = _now_run, trigger: dict | None = None,
                           query_name: str | None = None) -> StreamingQuery:
    """Start a streaming query that loads ``entity`` from ``source_stream``.

    ``checkpoint_location`` defaults to a folder under the session's shared
    ``spark.checkpoint.dir``. ``trigger`` is passed to ``writeStream.trigger``
    (for example ``{"availableNow": True}``). ``run_factory`` makes the run
    (load time, semantics) of each micro-batch from its epoch id.
    """
    if getattr(entity, "multiactive", False):
        raise ValueError(f"{entity.name}: a micro-batch may hold part of a multi-active set, which would replace the whole set")
    tune(spark)
    ensure_table(spark, table, table_columns(entity))
    if checkpoint_location is None:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            raise ValueError("no checkpoint_location and no spark.checkpoint.dir set")
        checkpoint_location = os.path.join(base, "streams", query_name or table.replace(".", "_"))

    def process(batch: DataFrame, epoch_id: int) -> None:
        load_batch(batch, entity, src, table, run_factory(epoch_id))

    writer = source_stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
