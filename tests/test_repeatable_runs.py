"""Runs that can be repeated after a crash, checks of business-vault SQL before writing, compaction."""

import glob

import pytest
from pyspark.sql import functions as F

from vaultsmith import Hub, Run, Source, VaultModel, hub_delta, stage_hub
from vaultsmith.plans import runner as runner_module
from vaultsmith.plans.dependencies import bv_levels
from vaultsmith.plans.dry_run import relations, vault_reads
from vaultsmith.plans.runner import VaultRunner
from vaultsmith.sinks.tables import append, by_partition, compact, ensure_table, table_columns, write_batch
from vaultsmith.sources.tables import list_vault_tables, vault_table

from .test_runner import MODEL_PATH, T1, T2, _reset, _write_sources


def contents(spark):
    return {t: sorted(map(str, spark.table(f"vault_demo.{t}").collect())) for t in list_vault_tables(spark, "vault_demo")}


@pytest.mark.parametrize("dies_after", [3, 10])
def test_a_killed_run_is_repeated(spark, monkeypatch, dies_after):
    model = VaultModel.from_yaml(MODEL_PATH)

    def both_runs(fail):
        _reset(spark)
        _write_sources(spark, 1)
        runner = VaultRunner(spark, model, repeatable=True, parallelism=1)
        runner.run(Run(load_ts=T1))
        _write_sources(spark, 2)
        if fail:
            done = []

            def dying(df, name):
                if len(done) == dies_after:
                    raise RuntimeError("killed")
                write_batch(df, name)
                done.append(name)

            monkeypatch.setattr(runner_module, "write_batch", dying)
            with pytest.raises(RuntimeError, match="killed"):
                runner.run(Run(load_ts=T2))
            monkeypatch.setattr(runner_module, "write_batch", write_batch)
        runner.run(Run(load_ts=T2))
        if fail:  # and once more, though nothing failed: rows with a NULL child key aren't doubled either
            runner.run(Run(load_ts=T2))
        return contents(spark)

    assert both_runs(True) == both_runs(False)
    assert spark.table("vault_demo.bv_s_rental").count() > 0


def test_a_batch_replaces_itself_only(spark, scratch_db, tmp_path):
    hub = Hub("h", hk="hk", bk="bk", sources=[Source("x", bks=["id"])])
    name = f"{scratch_db}.h"
    ensure_table(spark, name, table_columns(hub), "hk", 4, by_run=True)
    by_partition(spark)
    for k, ts in enumerate(["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-02-01 00:00:00"]):
        run = Run(load_ts=ts)
        staged = stage_hub(spark.range(0, 50 + 50 * min(k, 1)), hub, hub.sources[0], run)
        write_batch(hub_delta(staged, vault_table(spark, name, ["hk"], before=run), hub, run), name)
    got = {str(r["dv_loadts"]): r["n"] for r in spark.table(name).groupBy("dv_loadts").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"2024-01-01 00:00:00": 50, "2024-02-01 00:00:00": 50}


# ---------------------------------------------------------------- virtual sources
MODEL = """
connection: {schemas: {source: %(db)s, stage: %(db)s_stage, edwh: %(db)s_vault}}
rv:
  hubs: {h_a: {hk: hk_a, bk: a_bk, src: {rel: {bks: [a]}}}}
  sats: {s_a: {hk: hk_a, attrs: [v], src: {rel: {bks: [a], attrs: {v: v}}}}}
bv:
  hubs:
    bv_h: {hk: hk_b, bk: b_bk, %(deps)s src: {one: {bks: [b], sql: "%(first)s"}}}
  sats:
    bv_s: {hk: hk_b, attrs: [w], src: {two: {bks: [b], attrs: {w: w}, sql: "%(second)s"}}}
"""
FIRST = "WITH x AS (SELECT a_bk AS b, hk_a FROM %(db)s_vault.h_a) SELECT x.b, s.v AS w FROM x JOIN %(db)s_vault.s_a s ON s.hk_a = x.hk_a"
SECOND = "SELECT b_bk AS b, 'x' AS w FROM %(db)s_vault.BV_H WHERE b_bk IN (SELECT CAST(a AS STRING) FROM %(db)s.rel)"


def small_model(spark, db, first=FIRST, second=SECOND, deps=""):
    spark.createDataFrame([(1, "x"), (2, "y")], "a long, v string").write.mode("overwrite").saveAsTable(f"{db}.rel")
    return VaultModel.from_yaml(MODEL % {"db": db, "first": first % {"db": db}, "second": second % {"db": db}, "deps": deps})


@pytest.mark.parametrize("first,second,message", [
    (FIRST.replace("s.v AS w", "s.missing AS w"), SECOND, "missing"),
    (FIRST, SECOND.replace("'x' AS w", "'x' AS other"), "w"),
    (FIRST, "SELECT b, w FROM no_such_table", "no_such_table"),
    (FIRST, "SELEC b", "SELEC"),
])
def test_wrong_texts_raise_before_any_table_exists(spark, scratch_db, first, second, message):
    model = small_model(spark, scratch_db, first, second)
    with pytest.raises(ValueError, match=message):
        VaultRunner(spark, model).run(Run(load_ts=T1))
    assert not spark.catalog.databaseExists(f"{scratch_db}_vault")


def test_texts_may_read_tables_of_the_same_run(spark, scratch_db):
    model = small_model(spark, scratch_db)
    assert relations(spark, model.bv.sats["bv_s"].sources[0].sql) == {(f"{scratch_db}_vault", "bv_h"), (scratch_db, "rel")}
    assert vault_reads(spark, model) == {"bv_h": {"h_a", "s_a"}, "bv_s": {"bv_h"}}
    with pytest.warns(UserWarning, match="bv_s reads .'bv_h'. without declaring"):
        VaultRunner(spark, model).run(Run(load_ts=T1))
    assert spark.table(f"{scratch_db}_vault.bv_s").count() == 2
    with pytest.raises(ValueError, match="without declaring"):
        VaultRunner(spark, model).run(Run(load_ts=T2, semantics="strict"))


def test_a_cycle_names_its_tables(spark, scratch_db):
    model = small_model(spark, scratch_db, deps="dependencies: [load__bv_s],")
    with pytest.warns(UserWarning), pytest.raises(ValueError, match="cycle among .'bv_h', 'bv_s'."):
        bv_levels(model, reads=vault_reads(spark, model))


# -------------------------------------------------------------------- compaction
def test_compaction_after_many_loads(spark, scratch_db, tmp_path):
    hub = Hub("h", hk="hk", bk="bk", sources=[Source("x", bks=["id"])])
    name = f"{scratch_db}.h"
    ensure_table(spark, name, table_columns(hub), "hk", 4, location=str(tmp_path / "old"))
    for k in range(20):
        run = Run(load_ts=f"2024-01-{k + 1:02d} 00:00:00")
        staged = stage_hub(spark.range(10 * k, 10 * k + 10), hub, hub.sources[0], run)
        append(hub_delta(staged, vault_table(spark, name, ["hk"]), hub, run), name)
    reader = spark.table(name)  # planned before the switch
    rows = sorted(map(str, reader.collect()))
    left = compact(spark, name, str(tmp_path / "new"))
    assert left.endswith("/old") and len(glob.glob(str(tmp_path / "new" / "part-*"))) == 4
    assert sorted(map(str, spark.table(name).collect())) == rows == sorted(map(str, reader.collect())) and len(rows) == 200
    # The table goes on as before.
    run = Run(load_ts="2024-03-01 00:00:00")
    append(hub_delta(stage_hub(spark.range(195, 205), hub, hub.sources[0], run), vault_table(spark, name, ["hk"]), hub, run), name)
    assert spark.table(name).count() == 205
    assert f"{name}__compacted".split(".")[1] not in list_vault_tables(spark, scratch_db)


def test_compaction_gives_way_to_a_load(spark, scratch_db, tmp_path, monkeypatch):
    name = f"{scratch_db}.t"
    ensure_table(spark, name, [("k", "VARCHAR(256)")], location=str(tmp_path / "old"))
    spark.sql(f"INSERT INTO {name} VALUES ('a')")
    from pyspark.sql.readwriter import DataFrameWriter

    plain = DataFrameWriter.insertInto

    def slow(self, table, *args, **kw):
        plain(self, table, *args, **kw)
        if table.endswith("__compacted"):
            spark.sql(f"INSERT INTO {name} VALUES ('b')")

    monkeypatch.setattr(DataFrameWriter, "insertInto", slow)
    with pytest.raises(RuntimeError, match="written to"):
        compact(spark, name, str(tmp_path / "new"))
    assert sorted(r["k"] for r in spark.table(name).collect()) == ["a", "b"]
