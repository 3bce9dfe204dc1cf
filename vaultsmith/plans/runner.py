"""Run a whole vault model: stage, then load raw vault, then business vault.

The driver only decides the order and issues one append per target, all
of its sources together. Executors do all row work. Each delta is computed and appended in one job and never reused:
after the append the same lazy DataFrame would mean something else.
"""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.meta import HASHDIFF, SUBSEQ
from ..operators.effectivity import effectivity_delta
from ..operators.load import hub_delta, link_delta, sat_delta
from ..operators.stage import stage
from ..run import Run
from ..session import shuffles_removed, tune
from ..sinks.tables import append, by_partition, ensure_schema, ensure_table, table_columns, write_batch, write_stage
from ..sources.tables import SourceResolver, catalog_sources, vault_table, virtual_source
from ..spec import Effectivity, Hub, Layer, Link, Sat, VaultModel
from .dependencies import bv_levels
from .dry_run import check_virtual_sources, vault_reads

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    order: list[str] = field(default_factory=list)
    appended: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


@dataclass
class VaultRunner:
    """Runs a model against a Spark catalog.

    ``sources`` resolves a raw-vault source name to a DataFrame (default:
    catalog tables in the model's source schema). ``buckets`` buckets new
    vault tables by their hash key. ``materialize_stage`` writes each stage
    to ``<stage schema>.<source>__<target>`` first, as the original loader
    does; the loads then read the written table (lineage cut).
    """

    spark: SparkSession
    model: VaultModel
    sources: SourceResolver | None = None
    buckets: int | None = None
    materialize_stage: bool = False
    count_rows: bool = False
    # Entities of one wave are independent targets: their jobs are submitted
    # from this many driver threads at once (1 = one after another).
    parallelism: int = 4

    # New vault tables get a partition per run, and a run replaces its own: a run that died
    # half-way is simply run again, with the same times, and the tables come out the same.
    repeatable: bool = False

    # Apply the settings the loads rely on (AQE, measured broadcasts) to the session.
    tune_session: bool = True

    def __post_init__(self):
        self.model.validate()
        if self.tune_session:
            tune(self.spark)
        if self.repeatable:
            by_partition(self.spark)
        if self.sources is None:
            self.sources = catalog_sources(self.spark, self.model.source_schema)

    # ---------------------------------------------------------------- api
    def run(self, run: Run) -> RunReport:
        report = RunReport()
        levels = self.check_sources(run)
        ensure_schema(self.spark, self.model.vault_schema)
        if self.materialize_stage:
            ensure_schema(self.spark, self.model.stage_schema)
        with shuffles_removed(self.spark):
            self._load(levels, run, report)
        return report

    def _load(self, levels: list[list[str]], run: Run, report: RunReport) -> None:
        rv, bv = self.model.rv, self.model.bv
        # Raw vault: every hub, link and satellite is its own target (one wave);
        # an effectivity satellite reads its link's table, so it waits for that link.
        self._wave([*rv.entities(), *rv.effs.values()], rv, run, False, report)
        # Business vault: dependency levels, each level one wave.
        by_name = {e.name: e for e in [*bv.entities(), *bv.effs.values()]}
        for level in levels:
            self._wave([by_name[n] for n in level], bv, run, True, report)

    def check_sources(self, run: Run) -> list[list[str]]:
        """Resolve every source and build its stage plan, which checks the mapped columns,
        before anything is written; business-vault texts are analysed against empty relations of the
        tables this run loads (see ``dry_run``). Returns the order of the business vault."""
        for ent in [*self.model.rv.entities(), *self.model.rv.effs.values()]:
            spec = self.model.rv.links[ent.link] if isinstance(ent, Effectivity) else ent
            for src in spec.sources:
                stage(self._source_frame(src, False), spec, src, run, False)
        check_virtual_sources(self.spark, self.model, run)
        return bv_levels(self.model, run.strict, vault_reads(self.spark, self.model))

    def _wave(self, entities, layer: Layer, run: Run, business: bool, report: RunReport) -> None:
        """Load independent targets; an effectivity satellite listed after its
        link starts once that link is loaded."""
        if self.parallelism <= 1 or len(entities) <= 1:
            for ent in entities:
                self._load_entity(ent, layer, run, business, report)
            return
        futures = {}

        def after_link(ent):
            if ent.link in futures:
                futures[ent.link].result()
            self._load_entity(ent, layer, run, business, report)

        with ThreadPoolExecutor(max_workers=self.parallelism) as pool:
            # Links and the rest are queued first, so a waiting effectivity
            # task never holds a worker its link still needs.
            for ent in entities:
                if not isinstance(ent, Effectivity):
                    futures[ent.name] = pool.submit(self._load_entity, ent, layer, run, business, report)
            for ent in entities:
                if isinstance(ent, Effectivity):
                    futures[ent.name] = pool.submit(after_link, ent)
            for f in futures.values():
                f.result()

    def table_name(self, entity_name: str) -> str:
        return f"{self.model.vault_schema}.{entity_name}"

    # ------------------------------------------------------------ helpers
    def _source_frame(self, src, business: bool) -> DataFrame:
        return virtual_source(self.spark, src.sql) if business else self.sources(src.name)

    def _stages(self, ent, layer: Layer, run: Run, business: bool) -> list[DataFrame]:
        spec = layer.links[ent.link] if isinstance(ent, Effectivity) else ent
        out = []
        for src in spec.sources:
            st = stage(self._source_frame(src, business), spec, src, run, business)
            # An effectivity satellite stages its start and end rows instead (``_load_entity``).
            if self.materialize_stage and not isinstance(ent, Effectivity):
                st = write_stage(st, f"{self.model.stage_schema}.{src.name}__{ent.name}")
            out.append(st)
        return out

    def _ensure(self, ent, layer: Layer, run: Run) -> str:
        name = self.table_name(ent.name)
        link = layer.links[ent.link] if isinstance(ent, Effectivity) else None
        key = link.hk if link is not None else ent.hk
        ensure_table(self.spark, name, table_columns(ent, run.max_varchar, link), key, self.buckets,
                     by_run=self.repeatable)
        return name

    def _count(self, name: str) -> int:
        return self.spark.table(name).count() if self.count_rows else -1

    def _load_entity(self, ent, layer: Layer, run: Run, business: bool, report: RunReport) -> None:
        started = time.perf_counter()
        name = self._ensure(ent, layer, run)
        before = self._count(name)
        stages = self._stages(ent, layer, run, business)
        write = write_batch if self.repeatable else append
        if isinstance(ent, Hub):
            write(hub_delta(stages, self._target(name, run, [ent.hk]), ent, run), name)
        elif isinstance(ent, Link):
            keys = [ent.hk, *ent.cks.values()] if run.strict else [ent.hk]
            write(link_delta(stages, self._target(name, run, keys), ent, run), name)
        elif isinstance(ent, Sat):
            write(sat_delta(stages, self._target(name, run, self._sat_columns(ent, run)), ent, run), name)
        else:
            link = layer.links[ent.link]
            target = self._target(name, run)
            link_rows = vault_table(self.spark, self.table_name(link.name), [link.hk, *ent.drivers])
            delta = effectivity_delta(stages, target, link_rows, ent, link, run)
            if self.materialize_stage:
                delta = write_stage(delta, f"{self.model.stage_schema}.{link.name}__{ent.name}")
            write(delta, name)
        report.order.append(f"{'bv' if business else 'rv'}.{ent.name}")
        report.seconds[ent.name] = round(time.perf_counter() - started, 3)
        if self.count_rows:
            report.appended[ent.name] = self._count(name) - before
        log.info("loaded %s", name)

    def _target(self, name: str, run: Run, columns: list[str] | None = None) -> DataFrame | None:
        return vault_table(self.spark, name, columns, before=run if self.repeatable else None)

    def _sat_columns(self, sat: Sat, run: Run) -> list[str]:
        if sat.variant == "regular" and not run.strict:
            return [sat.hk]
        cols = [sat.hk, *sat.cks.values(), HASHDIFF, "dv_appts", "dv_loadts"]
        return [*cols, SUBSEQ] if sat.variant == "multiactive" else cols


def run_vault(spark: SparkSession, model: VaultModel, run: Run, **kw) -> RunReport:
    """Stage and load every entity of ``model`` for one run."""
    return VaultRunner(spark, model, **kw).run(run)
