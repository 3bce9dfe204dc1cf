"""Checked query: a whole two-layer model run twice over the given tables, read back from what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.load import union_all
from ..plans.runner import VaultRunner
from ..session import checkpoint_dir
from ..sinks.tables import ensure_schema
from ..sources.tables import list_vault_tables, mapping_sources
from ..spec import Link, Source, VaultModel
from . import sqltext as S
from .link_queries import link_load_sql, link_stage_sql
from .model import RUN, RUN_OLD, SHIP_SPLIT, T_OLD, table
from .registry import register

MODEL = """
connection: {schemas: {source: unused, stage: %(db)s_stage, edwh: %(db)s_vault}}
rv:
  hubs:
    h_customer: {hk: hk_customer, bk: customer_bk, src: {customer: {bks: [c_custkey]}}}
  links:
    l_part_supplier:
      {hk: hk_part_supplier, hks: [hk_part, hk_supplier], src: {lineitem: {bks: {l_partkey: hk_part, l_suppkey: hk_supplier}}}}
  sats:
    s_customer: {hk: hk_customer, attrs: [segment], src: {customer: {bks: [c_custkey], attrs: {c_mktsegment: segment}}}}
  effs:
    es_part_supplier: {link: l_part_supplier, drivers: [hk_part]}
bv:
  hubs:
    bv_h_builder:
      hk: hk_builder
      bk: builder_bk
      src:
        builders:
          bks: [customer_bk]
          sql: >-
            SELECT h.customer_bk FROM %(db)s_vault.h_customer h JOIN %(db)s_vault.s_customer s ON s.hk_customer = h.hk_customer
            WHERE s.segment = 'BUILDING'
"""
L_PART_SUPPLIER = Link("l_part_supplier", hk="hk_part_supplier", hks=["hk_part", "hk_supplier"],
                       sources=[Source("lineitem", bks={"l_partkey": "hk_part", "l_suppkey": "hk_supplier"})])
_LSRC = L_PART_SUPPLIER.sources[0]
_OLD_LINES = f"(SELECT * FROM lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}) ol"
_CUSTOMER_KEY = S.hk([S.kt("c_custkey")])


def _sql() -> str:
    row = "SELECT {name} AS table_name, count(*) AS n_rows, min({key}) AS first_key, max({key}) AS last_key FROM {frm}"
    counted = lambda name, frm, key="k": row.format(name=S.q(name), key=key, frm=frm)
    return (
        f"WITH os AS ({link_stage_sql(L_PART_SUPPLIER, _LSRC, _OLD_LINES, T_OLD)}), "
        f"ol AS ({link_load_sql(L_PART_SUPPLIER, 'os', [])}), "
        f"s AS ({link_stage_sql(L_PART_SUPPLIER, _LSRC, 'lineitem')}), nl AS ({link_load_sql(L_PART_SUPPLIER, 's', ['ol'])}), "
        "l AS (SELECT hk_part_supplier AS k FROM ol UNION ALL SELECT hk_part_supplier FROM nl), "
        "opened AS (SELECT DISTINCT hk_part_supplier AS k FROM s WHERE hk_part_supplier NOT IN (SELECT hk_part_supplier FROM os)), "
        f"c AS (SELECT {_CUSTOMER_KEY} AS k, c_mktsegment FROM customer), "
        "b AS (SELECT k FROM c WHERE c_mktsegment = 'BUILDING') "
        + " UNION ALL ".join([
            counted("vault.h_customer", "c"), counted("vault.s_customer", "(SELECT DISTINCT * FROM c)"), counted("vault.l_part_supplier", "l"),
            counted("vault.es_part_supplier", "(SELECT DISTINCT k FROM l)"), counted("vault.bv_h_builder", "b"),
            counted("stage.customer__h_customer", "c"), counted("stage.customer__s_customer", "c"),
            counted("stage.lineitem__l_part_supplier", "s", "hk_part_supplier"),
            counted("stage.l_part_supplier__es_part_supplier", "opened"), counted("stage.builders__bv_h_builder", "b")]))


@register("vault_run", _sql())
def vault_run(spark, d):
    """Stage, raw vault and business vault, run over the lines shipped before a date and then over all; the second
    run is started twice, as after a crash. One row per vault and stage table, as the catalog lists them."""
    db = f"vaultsmith_run_{uuid.uuid4().hex}"
    folder = checkpoint_dir(spark).rstrip("/")
    for schema in ("stage", "vault"):
        ensure_schema(spark, f"{db}_{schema}", f"{folder}/{db}_{schema}")
    lines, customers = table(spark, d, "lineitem"), table(spark, d, "customer")
    old = lines.where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz"))
    model = VaultModel.from_yaml(MODEL % {"db": db})
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        for rows, run in ((old, RUN_OLD), (lines, RUN), (lines, RUN)):
            sources = mapping_sources({"lineitem": rows, "customer": customers})
            VaultRunner(spark, model, sources=sources, materialize_stage=True, repeatable=True, tune_session=False).run(run)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    out = []
    for schema in ("vault", "stage"):
        for name in list_vault_tables(spark, f"{db}_{schema}"):
            found = spark.table(f"{db}_{schema}.{name}")
            key = found.columns[0]
            out.append(found.agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
                       .select(F.lit(f"{schema}.{name}").alias("table_name"), "n_rows", "first_key", "last_key"))
    return union_all(out)
