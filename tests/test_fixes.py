"""One test per point of the last review of the vault loaders."""

import glob

import pytest
from pyspark.sql import functions as F

from vaultsmith import Hub, Run, Sat, Source, VaultModel, stage_hub, stage_sat
from vaultsmith.catalog import registry
from vaultsmith.plans.dependencies import task_names
from vaultsmith.plans.explain import plan_text
from vaultsmith.plans.runner import VaultRunner
from vaultsmith.session import checkpoint_dir
from vaultsmith.sinks.tables import append, ensure_table, table_columns
from vaultsmith.sources.tables import jdbc_sources
from vaultsmith.streaming.incremental import start_incremental_load

from .conftest import SF_SMALL

RUN = Run(load_ts="2024-06-01 00:00:00")
STRICT = Run(load_ts="2024-06-01 00:00:00", semantics="strict")
TEXT = Sat("s_text", hk="hk", attrs=["t"], sources=[Source("x", bks=["id"], attrs={"t": "t"})])


def test_strict_attributes_are_not_cut(spark):
    df = spark.createDataFrame([(1, "x" * 256 + "abc"), (2, "x" * 256 + "abd")], "id long, t string")
    rows = stage_sat(df, TEXT, TEXT.sources[0], STRICT).collect()
    assert sorted(r["t"][-3:] for r in rows) == ["abc", "abd"]
    assert len({r["dv_hashdiff"] for r in rows}) == 2


def test_strict_keys_wider_than_the_column_raise(spark):
    hub = Hub("h", hk="hk", bk="bk", sources=[Source("x", bks=["t"])])
    df = spark.createDataFrame([("k" * 300,)], "t string")
    with pytest.raises(Exception, match="wider than 256"):
        stage_hub(df, hub, hub.sources[0], STRICT).collect()
    assert len(stage_hub(df, hub, hub.sources[0], RUN).first()["bk"]) == 256


def test_binary_and_boolean_text_in_the_hashdiff(spark):
    import hashlib

    sat = Sat("s", hk="hk", attrs=["b", "f"], sources=[Source("x", bks=["id"], attrs={"b": "b", "f": "f"})])
    df = spark.createDataFrame([(1, bytearray(b"\x01\xab"), True)], "id long, b binary, f boolean")
    row = stage_sat(df, sat, sat.sources[0], RUN).first()
    assert row["dv_hashdiff"] == hashlib.md5(b"\\x01ab|t").hexdigest() and row["f"] == "true"


def test_column_names_with_dots(spark):
    hub = Hub("h", hk="hk", bk="bk", sources=[Source("x", bks=["a.b"])])
    df = spark.createDataFrame([(7,)], "`a.b` long")
    assert stage_hub(df, hub, hub.sources[0], RUN).first()["bk"] == "7"


def test_jdbc_tables_need_partitioning(spark):
    read = jdbc_sources(spark, "jdbc:none:", "src", {"a": {"column": "id"}})
    for name in ("a", "b"):
        with pytest.raises(ValueError, match="partition column"):
            read(name)


def test_checkpoint_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


MODEL = """
connection: {schemas: {source: %(db)s, stage: %(db)s_stage, edwh: %(db)s_vault}}
rv:
  hubs: {h_a: {hk: hk_a, bk: a_bk, src: {rel: {bks: [a]}}}}
  links: {l_ab: {hk: hk_ab, hks: [hk_a, hk_b], src: {rel: {bks: [{a: hk_a}, {b: hk_b}]}}}}
  sats: {s_a: {hk: hk_a, attrs: [v], cks: [{k: k_ck}], src: {rel: {bks: [a], attrs: [{%(attr)s: v}]}}}}
  effs: {es_ab: {link: l_ab, drivers: [hk_a]}}
bv: {}
"""


def test_list_forms_stage_of_effectivity_and_its_task_name(spark, scratch_db):
    spark.createDataFrame([(1, 2, 3, "x")], "a long, b long, k long, v string").write.saveAsTable(f"{scratch_db}.rel")
    model = VaultModel.from_yaml(MODEL % {"db": scratch_db, "attr": "v"})
    assert "load__es_ab" in task_names(model)
    VaultRunner(spark, model, materialize_stage=True).run(RUN)
    staged = spark.table(f"{scratch_db}_stage.l_ab__es_ab")
    assert {"dv_startts", "dv_endts"} <= set(staged.columns) and staged.count() == 1
    assert spark.table(f"{scratch_db}_vault.s_a").first()["k_ck"] == "-1"


def test_columns_are_checked_before_anything_is_written(spark, scratch_db):
    spark.createDataFrame([(1, 2, 3, "x")], "a long, b long, k long, v string").write.saveAsTable(f"{scratch_db}.rel")
    model = VaultModel.from_yaml(MODEL % {"db": scratch_db, "attr": "missing"})
    with pytest.raises(ValueError, match="missing"):
        VaultRunner(spark, model).run(RUN)
    assert not spark.catalog.databaseExists(f"{scratch_db}_vault")


def test_a_bucketed_append_writes_about_one_file_per_bucket(spark, scratch_db, tmp_path):
    hub = Hub("h", hk="hk", bk="bk", sources=[Source("x", bks=["id"])])
    name = f"{scratch_db}.h"
    ensure_table(spark, name, table_columns(hub), "hk", 16, location=str(tmp_path / "h"))
    df = spark.range(0, 5000, numPartitions=16)
    append(stage_hub(df, hub, hub.sources[0], RUN), name)
    assert spark.table(name).count() == 5000
    assert len(glob.glob(str(tmp_path / "h" / "part-*"))) <= 20


def test_streams_reject_multi_active(spark):
    sat = Sat("s", hk="hk", attrs=["t"], multiactive=True, sources=[Source("x", bks=["id"], attrs={"t": "t"})])
    with pytest.raises(ValueError, match="multi-active"):
        start_incremental_load(spark, None, sat, sat.sources[0], "t")


def test_plans_of_latest_rows_and_set_changes(spark):
    ckey = plan_text(registry.queries()["load_sat_ckey"](spark, SF_SMALL), "simple")
    assert "Window" not in ckey
    # Two chained loads; planned without AQE, equal exchanges show as reused.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    sets = plan_text(registry.queries()["load_sat_multiactive"](spark, SF_SMALL), "simple")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sets.count("- Exchange hashpartitioning") <= 24


def test_applied_time_decides_the_latest_row(spark):
    from vaultsmith.functions.windows import latest_rows

    df = spark.sql("SELECT * FROM VALUES (1, 'a', TIMESTAMP_NTZ '2024-02-01', TIMESTAMP_NTZ '2024-01-01'), "
                   "(1, 'b', TIMESTAMP_NTZ '2024-01-01', TIMESTAMP_NTZ '2024-03-01'), (2, 'c', NULL, TIMESTAMP_NTZ '2024-01-01'), "
                   "(2, 'd', TIMESTAMP_NTZ '2030-01-01', TIMESTAMP_NTZ '2024-01-01') AS t(k, v, dv_appts, dv_loadts)")
    got = latest_rows(df, ["k"], ["v"]).where(F.col("k").isNotNull()).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "c")]
