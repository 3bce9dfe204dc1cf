"""Checked queries: effectivity satellite over part-supplier relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.effectivity import effectivity_delta
from ..operators.load import link_delta
from ..operators.stage import stage_link
from ..spec import Effectivity, Link, Source
from . import sqltext as S
from .link_queries import link_stage_sql
from .model import RUN, RUN_OLD, SHIP_SPLIT, T_OLD, T_RUN, table
from .registry import register

L_PART_SUPPLIER = Link(
    "l_part_supplier", hk="hk_part_supplier", hks=["hk_part", "hk_supplier"],
    sources=[Source("lineitem", bks={"l_partkey": "hk_part", "l_suppkey": "hk_supplier"})],
)
ES_PART_SUPPLIER = Effectivity("es_part_supplier", link="l_part_supplier", drivers=["hk_part"])
_SRC = L_PART_SUPPLIER.sources[0]

# Snapshots of the relation: before the split (already loaded), and a later
# snapshot that starts two years earlier, so the two overlap.
SNAPSHOT_FROM = "1997-01-01"
HIGH_DATE = "9999-12-31 00:00:00"
_OLD_FROM = f"(SELECT * FROM lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}) ol"
_NEW_FROM = f"(SELECT * FROM lineitem WHERE l_shipdate >= {S.ts(SNAPSHOT_FROM + ' 00:00:00')}) nl"


def _period(start: str, end: str) -> str:
    return S.md5_plain([S.txt(start), S.txt(end)])


def _effectivity_sql() -> str:
    hk, drv = L_PART_SUPPLIER.hk, "hk_part"
    task = "load_" + ES_PART_SUPPLIER.name
    high, old, run = S.ts(HIGH_DATE), S.ts(T_OLD), S.ts(T_RUN)
    meta = "dv_recsrc, dv_tenant, dv_bkeycode"
    return (
        f"WITH ol AS ({link_stage_sql(L_PART_SUPPLIER, _SRC, _OLD_FROM, T_OLD)}), "
        f"lnk AS (SELECT {hk}, {drv} FROM ol), "
        f"eff AS (SELECT {hk}, {old} AS dv_startts, {high} AS dv_endts, {_period(old, high)} AS dv_hashdiff, "
        f"{old} AS dv_loadts, {old} AS dv_appts, {meta}, {S.q(task)} AS dv_taskid "
        f"FROM (SELECT DISTINCT {hk}, {meta} FROM ol) x), "
        f"last AS (SELECT {hk}, arg_max(struct_pack(st := dv_startts, en := dv_endts, rs := dv_recsrc, te := dv_tenant, "
        f"bc := dv_bkeycode), {S.newest()}) AS r FROM eff GROUP BY {hk}), "
        f"s AS ({link_stage_sql(L_PART_SUPPLIER, _SRC, _NEW_FROM)}), "
        f"known AS (SELECT DISTINCT {hk}, {drv} FROM lnk), "
        f"rel AS (SELECT {hk}, max(dv_recsrc) AS rs, max(dv_tenant) AS te, max(dv_bkeycode) AS bc FROM s GROUP BY {hk}), "
        f"pairs AS (SELECT coalesce(rel.{hk}, last.{hk}) AS {hk}, rel.{hk} IS NOT NULL AS seen, "
        f"coalesce(last.r.en = {high}, false) AS is_open, rel.rs, rel.te, rel.bc, last.r AS r "
        f"FROM rel FULL JOIN last ON rel.{hk} = last.{hk}) "
        f"SELECT {hk}, {run} AS dv_startts, {high} AS dv_endts, {_period(run, high)} AS dv_hashdiff, "
        f"{run} AS dv_loadts, {run} AS dv_appts, rs AS dv_recsrc, te AS dv_tenant, bc AS dv_bkeycode, {S.q(task)} AS dv_taskid "
        f"FROM pairs WHERE seen AND NOT is_open "
        f"UNION ALL "
        f"SELECT b.{hk}, b.r.st AS dv_startts, {run} AS dv_endts, {_period('b.r.st', run)} AS dv_hashdiff, "
        f"{run} AS dv_loadts, {run} AS dv_appts, b.r.rs AS dv_recsrc, b.r.te AS dv_tenant, b.r.bc AS dv_bkeycode, {S.q(task)} AS dv_taskid "
        f"FROM pairs b JOIN known USING ({hk}) WHERE is_open AND NOT seen AND {drv} IN (SELECT {drv} FROM s)"
    )


@register("effectivity_open_close", _effectivity_sql())
def effectivity_open_close(spark, d):
    li = table(spark, d, "lineitem")
    old_lines = li.where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz"))
    new_lines = li.where(F.col("l_shipdate") >= F.lit(SNAPSHOT_FROM).cast("timestamp_ntz"))
    old_stage = stage_link(old_lines, L_PART_SUPPLIER, _SRC, RUN_OLD)
    link_rows = link_delta(old_stage, None, L_PART_SUPPLIER, RUN_OLD)
    eff = effectivity_delta(old_stage, None, None, ES_PART_SUPPLIER, L_PART_SUPPLIER, RUN_OLD)
    stage = stage_link(new_lines, L_PART_SUPPLIER, _SRC, RUN)
    return effectivity_delta(stage, eff, link_rows, ES_PART_SUPPLIER, L_PART_SUPPLIER, RUN)
