"""End to end: the demo model over small source tables, several runs."""

import datetime as dt
import os
import warnings

import pytest

from vaultsmith import Run, VaultModel
from vaultsmith.plans.dependencies import bv_order
from vaultsmith.plans.runner import VaultRunner
from vaultsmith.sources.tables import list_vault_tables

MODEL_PATH = os.path.join(os.path.dirname(__file__), "fixtures", "demo_model.yaml")
SCHEMAS = ("src_demo", "stg_demo", "vault_demo")

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)
T3 = dt.datetime(2024, 3, 1)


def _reset(spark):
    for s in SCHEMAS:
        spark.sql(f"DROP DATABASE IF EXISTS {s} CASCADE")
    spark.sql("CREATE DATABASE src_demo")


def _write_sources(spark, version: int):
    d = dt.datetime(2023, 5, 1)
    customers = [(1, "ann", 1), (2, "bob", 1), (3, "cid", 0)] + ([(4, "dee", 1)] if version > 1 else [])
    actors = [(10, "Al", "Pa"), (11, "Bo", "Qu")]
    if version > 1:
        actors = [(10, "Alan", "Pa"), (11, "Bo", "Qu"), (12, "Cy", "Ro")]
    films = [(100, "Up", 2001), (100, "Up (dub)", 2001), (101, "Go", 1999)]
    if version > 1:
        films = [(100, "Up", 2001), (101, "Go", 1999), (101, "Go 2", 2003)]
    film_actor = [(100, 10), (101, 11)] + ([(101, 12)] if version > 1 else [])
    inventory = [(1000,), (1001,)]
    rentals = [(5000, 1000, 1, d, None), (5001, 1001, 2, d, "late")]
    if version > 1:
        rentals = [(5000, 1000, 1, d, None), (5002, 1001, 4, d, "ok"), (5003, 1002, 2, d, None)]
    frames = {
        "customer": spark.createDataFrame(customers, "customer_id int, name string, active int"),
        "actor": spark.createDataFrame(actors, "actor_id int, first_name string, last_name string"),
        "film": spark.createDataFrame(films, "film_id int, title string, release_year int"),
        "film_actor": spark.createDataFrame(film_actor, "film_id int, actor_id int"),
        "inventory": spark.createDataFrame(inventory, "inventory_id int"),
        "rental": spark.createDataFrame(
            rentals, "rental_id int, inventory_id int, customer_id int, rental_date timestamp_ntz, return_note string"),
    }
    for name, df in frames.items():
        df.write.mode("overwrite").saveAsTable(f"src_demo.{name}")


def _counts(spark):
    return {t: spark.table(f"vault_demo.{t}").count() for t in list_vault_tables(spark, "vault_demo")}


@pytest.fixture()
def model():
    return VaultModel.from_yaml(MODEL_PATH)


@pytest.mark.parametrize("buckets", [None, 4])
def test_two_runs_and_rerun(spark, model, buckets):
    _reset(spark)
    _write_sources(spark, 1)
    runner = VaultRunner(spark, model, buckets=buckets, count_rows=True)
    r1 = runner.run(Run(load_ts=T1))
    assert r1.order.index("bv.bv_h_customer") < r1.order.index("bv.bv_s_rental")
    c1 = _counts(spark)
    # A new key staged twice (film 100 has two rows) loads twice: no DISTINCT in hub loads.
    assert c1["h_customer"] == 3 and c1["h_actor"] == 2 and c1["h_film"] == 3
    assert c1["h_inventory"] == 2  # inventory first; rental adds no new key
    assert c1["s_film"] == 3 and c1["l_rental"] == 2 and c1["es_rental"] == 2
    assert c1["bv_h_customer"] == 2  # virtual source: active customers only

    _write_sources(spark, 2)
    r2 = runner.run(Run(load_ts=T2))
    a = r2.appended
    assert a["h_customer"] == 1 and a["h_actor"] == 1
    assert a["h_inventory"] == 1  # 1002 comes from the second source (rental)
    assert a["s_actor"] == 1  # reference: the renamed actor 10 is not recorded
    assert a["s_film"] == 3  # film 100's set shrank (1 row), film 101's grew (2 rows): reloaded whole
    assert a["l_rental"] == 2 and a["l_film_actor"] == 1
    # Inventory 1001 moved from customer 2 to 4: close one record, open two new relations.
    assert a["es_rental"] == 3

    vault = spark.table("vault_demo.s_film").where("dv_loadts = TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    assert sorted(r.dv_subseq for r in vault.collect()) == [1, 1, 2]

    r3 = runner.run(Run(load_ts=T3))
    # Rerunning the same sources adds nothing, except rows whose business-vault
    # child key is NULL (a NULL never equals itself).
    nonzero = {k: v for k, v in r3.appended.items() if v}
    assert nonzero == {"bv_s_rental": 2}


def test_materialized_stage_tables(spark, model):
    _reset(spark)
    _write_sources(spark, 1)
    VaultRunner(spark, model, materialize_stage=True).run(Run(load_ts=T1))
    stages = list_vault_tables(spark, "stg_demo")
    assert "customer__h_customer" in stages and "rental__h_inventory" in stages
    assert spark.table("stg_demo.actor__s_actor").count() == 2


def test_strict_run(spark, model):
    _reset(spark)
    _write_sources(spark, 1)
    runner = VaultRunner(spark, model, count_rows=True)
    runner.run(Run(load_ts=T1, semantics="strict"))
    _write_sources(spark, 2)
    a = runner.run(Run(load_ts=T2, semantics="strict")).appended
    assert a["s_actor"] == 2  # strict: the rename of actor 10 is recorded too
    a3 = runner.run(Run(load_ts=T3, semantics="strict")).appended
    assert not any(a3.values())  # strict loads are idempotent


def test_dependency_resolution_reference_and_strict(model):
    assert bv_order(model) == ["bv_h_customer", "bv_l_rental", "bv_s_rental"]
    model.bv.hubs["bv_h_customer"].dependencies = ["bv_s_rent"]  # substring of a task name
    model.bv.sats["bv_s_rental"].dependencies = ["load__bv_h_customer"]
    with pytest.raises(ValueError, match="cycle"):
        bv_order(model)
    model.bv.hubs["bv_h_customer"].dependencies = ["no_such_task"]
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert bv_order(model)[0] == "bv_h_customer"
        assert any("matches no task" in str(x.message) for x in w)
    with pytest.raises(ValueError, match="unknown dependency"):
        bv_order(model, strict=True)


def test_model_validation(model):
    model.rv.sats["s_film"].cks = {"film_id": "film_ck"}
    with pytest.raises(ValueError, match="multi-active"):
        model.validate()


def test_yaml_defaults(model):
    actor = model.rv.hubs["h_actor"].sources[0]
    assert (actor.tenant, actor.bkeycode) == ("default", "default")
    assert model.rv.links["l_rental"].cks == {"rental_id": "rental_id_ck"}
    assert model.rv.sats["s_film"].variant == "multiactive" and model.rv.sats["s_rental"].variant == "ckey"


def test_command_line_validates_model(capsys):
    from vaultsmith.__main__ import main

    assert main(["run", MODEL_PATH, "--validate-only"]) == 0
    out = capsys.readouterr().out
    assert '"valid": true' in out and "s_film" in out


def test_command_line_runs_parquet_sources(spark, tmp_path):
    from vaultsmith.__main__ import main

    model = tmp_path / "m.yaml"
    model.write_text(
        "connection: {schemas: {source: tpch_src, stage: tpch_stg, edwh: cli_vault}}\n"
        "rv:\n  hubs:\n    h_customer: {hk: hk_customer, bk: customer_bk, src: {customer: {bks: [c_custkey]}}}\n"
    )
    spark.sql("DROP DATABASE IF EXISTS cli_vault CASCADE")
    assert main(["run", str(model), "--sources", "parquet:/root/testdata/sf0.001",
                 "--load-ts", "2024-06-01 00:00:00"]) == 0
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert spark.table("cli_vault.h_customer").count() == n
    spark.sql("DROP DATABASE cli_vault CASCADE")
