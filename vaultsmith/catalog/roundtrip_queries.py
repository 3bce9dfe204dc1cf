"""Checked queries that write vault tables: first load, second load, read back.

The tables live in fresh folders of the shared checkpoint folder, in a database
of their own; the query's result is the written table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.effectivity import effectivity_delta
from ..operators.load import hub_delta, link_delta, sat_delta
from ..operators.stage import stage_bv_link, stage_hub, stage_link, stage_sat
from ..session import checkpoint_dir
from ..sinks.tables import append, ensure_schema, ensure_table, table_columns
from ..sources.tables import vault_table
from ..spec import Effectivity, Link, Sat, Source
from . import sqltext as S
from .bv_queries import _LINK_SRC, _ORDER_CUST_COLS, _from, _views, BV_L_ORDER, SQL_ORDER_CUSTOMER
from .hub_queries import hub_load_sql, hub_stage_sql
from .link_queries import link_load_sql, link_stage_sql
from .model import (
    H_CUSTOMER,
    L_LINEITEM,
    L_ORDER_SUPPLIER,
    RUN,
    RUN_OLD,
    S_CUSTOMER,
    S_LINE,
    S_ORDER_PARTS,
    SHIP_SPLIT,
    SRC_CUSTOMER,
    T_OLD,
    T_RUN,
    table,
)
from .registry import register
from .sat_queries import sat_ckey_load_sql, sat_multiactive_load_sql, sat_regular_load_sql, sat_stage_sql

DATABASE = "vaultsmith_roundtrip"


def _new_table(spark, entity, buckets: int | None = None, link: Link | None = None) -> str:
    name = f"{entity.name}_{uuid.uuid4().hex}"
    folder = checkpoint_dir(spark).rstrip("/")
    ensure_schema(spark, DATABASE, f"{folder}/{DATABASE}")
    ensure_table(spark, f"{DATABASE}.{name}", table_columns(entity, link=link), link.hk if link else entity.hk, buckets,
                 location=f"{folder}/{DATABASE}/{name}")
    return f"{DATABASE}.{name}"


def _old(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz"))


_OLD_FROM = f"(SELECT * FROM lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}) ol"
_OLD_CUSTOMERS = "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') oc"


def _restamp(cols: str, load_ts: str, task: str, frm: str) -> str:
    return f"SELECT {cols}, {S.load_meta(load_ts, task)} FROM {frm} s"


# ------------------------------------------------------------------- hub, link
@register("vault_roundtrip_hub",
          f"WITH os AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, _OLD_CUSTOMERS, T_OLD)}), "
          f"tgt AS ({_restamp('s.hk_customer, s.customer_bk', T_OLD, 'load_h_customer', 'os')}), "
          f"s AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, 'customer')}) "
          f"SELECT * FROM tgt UNION ALL {hub_load_sql(H_CUSTOMER, 's', ['tgt'])}")
def vault_roundtrip_hub(spark, d):
    """A hub in four buckets, loaded twice."""
    name = _new_table(spark, H_CUSTOMER, buckets=4)
    cust = table(spark, d, "customer")
    for rows, run in ((cust.where("c_mktsegment = 'BUILDING'"), RUN_OLD), (cust, RUN)):
        target = vault_table(spark, name, [H_CUSTOMER.hk])
        append(hub_delta(stage_hub(rows, H_CUSTOMER, SRC_CUSTOMER, run), target, H_CUSTOMER, run), name)
    return vault_table(spark, name)


_LCOLS = "s.hk_lineitem, s.hk_order, s.hk_part, s.hk_supplier, s.linenumber_ck"


@register("vault_roundtrip_link",
          f"WITH os AS ({link_stage_sql(L_LINEITEM, L_LINEITEM.sources[0], _OLD_FROM, T_OLD)}), "
          f"tgt AS ({_restamp(_LCOLS, T_OLD, 'load_l_lineitem', 'os')}), "
          f"s AS ({link_stage_sql(L_LINEITEM, L_LINEITEM.sources[0], 'lineitem')}) "
          f"SELECT * FROM tgt UNION ALL {link_load_sql(L_LINEITEM, 's', ['tgt'])}")
def vault_roundtrip_link(spark, d):
    name = _new_table(spark, L_LINEITEM)
    for rows, run in ((_old(spark, d), RUN_OLD), (table(spark, d, "lineitem"), RUN)):
        staged = stage_link(rows, L_LINEITEM, L_LINEITEM.sources[0], run)
        append(link_delta(staged, vault_table(spark, name, [L_LINEITEM.hk]), L_LINEITEM, run), name)
    return vault_table(spark, name)


# ------------------------------------------------------------------ satellites
def _sat_sql(sat: Sat, load_sql, old_from: str, frm: str) -> str:
    src = sat.sources[0]
    return (f"WITH os AS ({sat_stage_sql(sat, src, old_from, T_OLD)}), tgt AS ({load_sql(sat, 'os', None, T_OLD)}), "
            f"s AS ({sat_stage_sql(sat, src, frm)}), d AS ({load_sql(sat, 's', 'tgt', T_RUN)}) "
            "SELECT * FROM tgt UNION ALL SELECT * FROM d")


def _sat_table(spark, sat: Sat, old, new):
    name = _new_table(spark, sat)
    for rows, run in ((old, RUN_OLD), (new, RUN)):
        append(sat_delta(stage_sat(rows, sat, sat.sources[0], run), vault_table(spark, name), sat, run), name)
    return vault_table(spark, name)


@register("vault_roundtrip_sat_regular", _sat_sql(S_CUSTOMER, sat_regular_load_sql, _OLD_CUSTOMERS, "customer"))
def vault_roundtrip_sat_regular(spark, d):
    cust = table(spark, d, "customer")
    return _sat_table(spark, S_CUSTOMER, cust.where("c_mktsegment = 'BUILDING'"), cust)


@register("vault_roundtrip_sat_ckey", _sat_sql(S_LINE, sat_ckey_load_sql, _OLD_FROM, "lineitem"))
def vault_roundtrip_sat_ckey(spark, d):
    return _sat_table(spark, S_LINE, _old(spark, d), table(spark, d, "lineitem"))


@register("vault_roundtrip_sat_multiactive", _sat_sql(S_ORDER_PARTS, sat_multiactive_load_sql, _OLD_FROM, "lineitem"))
def vault_roundtrip_sat_multiactive(spark, d):
    return _sat_table(spark, S_ORDER_PARTS, _old(spark, d), table(spark, d, "lineitem"))


# ------------------------------------------------------------- several sources
# The second source re-delivers the returned lines under its own name.
_RETURNS_FROM = "(SELECT * FROM lineitem WHERE l_returnflag = 'R') rl"
_NEW_FROM = f"(SELECT * FROM lineitem WHERE l_shipdate >= {S.ts(SHIP_SPLIT + ' 00:00:00')}) nl"


def _new(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit(SHIP_SPLIT).cast("timestamp_ntz"))


def _returns(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R'")


_L2 = L_ORDER_SUPPLIER.sources[0]
_L2R = Source("returns", bks=dict(_L2.bks))


@register("load_link_multi_source",
          f"WITH s1 AS ({link_stage_sql(L_ORDER_SUPPLIER, _L2, _NEW_FROM)}), "
          f"s2 AS ({link_stage_sql(L_ORDER_SUPPLIER, _L2R, _RETURNS_FROM)}), "
          f"d1 AS ({link_load_sql(L_ORDER_SUPPLIER, 's1', [])}) "
          f"SELECT * FROM d1 UNION ALL {link_load_sql(L_ORDER_SUPPLIER, 's2', ['d1'])}")
def load_link_multi_source(spark, d):
    """Source 2 adds the links that source 1 lacks."""
    stages = [stage_link(_new(spark, d), L_ORDER_SUPPLIER, _L2, RUN), stage_link(_returns(spark, d), L_ORDER_SUPPLIER, _L2R, RUN)]
    return link_delta(stages, None, L_ORDER_SUPPLIER, RUN)


S_LINE_REGULAR_2 = Sat("s_line_regular", hk="hk_order", attrs=["quantity", "price", "shipdate"],
                       sources=[S_LINE.sources[0], Source("returns", bks=["l_orderkey"], attrs=dict(S_LINE.sources[0].attrs))])


@register("load_sat_regular_multi_source",
          f"WITH s1 AS ({sat_stage_sql(S_LINE_REGULAR_2, S_LINE_REGULAR_2.sources[0], _NEW_FROM)}), "
          f"s2 AS ({sat_stage_sql(S_LINE_REGULAR_2, S_LINE_REGULAR_2.sources[1], _RETURNS_FROM)}), "
          f"d1 AS ({sat_regular_load_sql(S_LINE_REGULAR_2, 's1', None)}) "
          f"SELECT * FROM d1 UNION ALL SELECT * FROM ({sat_regular_load_sql(S_LINE_REGULAR_2, 's2', 'd1')})")
def load_sat_regular_multi_source(spark, d):
    first, second = S_LINE_REGULAR_2.sources
    stages = [stage_sat(_new(spark, d), S_LINE_REGULAR_2, first, RUN), stage_sat(_returns(spark, d), S_LINE_REGULAR_2, second, RUN)]
    return sat_delta(stages, None, S_LINE_REGULAR_2, RUN)


_HIGH = "9999-12-31 00:00:00"
ES_ORDER_SUPPLIER = Effectivity("es_order_supplier", link="l_order_supplier", drivers=["hk_order", "hk_supplier"])


def _first_periods() -> str:
    meta = ", ".join(f"arg_min({c}, o) AS {c}" for c in ("dv_recsrc", "dv_tenant", "dv_bkeycode"))
    start, end = S.ts(T_RUN), S.ts(_HIGH)
    return (f"WITH s1 AS ({link_stage_sql(L_ORDER_SUPPLIER, _L2, _NEW_FROM)}), "
            f"s2 AS ({link_stage_sql(L_ORDER_SUPPLIER, _L2R, _RETURNS_FROM)}), "
            "u AS (SELECT *, 1 AS o FROM s1 UNION ALL SELECT *, 2 AS o FROM s2), "
            f"k AS (SELECT hk_order_supplier, {meta} FROM u GROUP BY hk_order_supplier) "
            f"SELECT hk_order_supplier, {start} AS dv_startts, {end} AS dv_endts, "
            f"md5(CAST({start} AS VARCHAR) || '|' || CAST({end} AS VARCHAR)) AS dv_hashdiff, {start} AS dv_loadts, "
            f"{start} AS dv_appts, dv_recsrc, dv_tenant, dv_bkeycode, 'load_es_order_supplier' AS dv_taskid FROM k")


@register("effectivity_multi_source", _first_periods())
def effectivity_multi_source(spark, d):
    """Two sources and two driving keys: every relation opens once, from the first source that has it."""
    stages = [stage_link(_new(spark, d), L_ORDER_SUPPLIER, _L2, RUN), stage_link(_returns(spark, d), L_ORDER_SUPPLIER, _L2R, RUN)]
    return effectivity_delta(stages, None, None, ES_ORDER_SUPPLIER, L_ORDER_SUPPLIER, RUN)


def _bv_link_stage(frm: str) -> str:
    return link_stage_sql(BV_L_ORDER, _LINK_SRC, frm, columns=_ORDER_CUST_COLS, business=True)


_BV_OLD = f"(SELECT * FROM ({SQL_ORDER_CUSTOMER}) x WHERE o_orderpriority < '3') y"


@register("bv_load_link",
          f"WITH tgt AS ({_bv_link_stage(_BV_OLD)}), s AS ({_bv_link_stage(_from(SQL_ORDER_CUSTOMER))}) "
          + link_load_sql(BV_L_ORDER, "s", ["tgt"]))
def bv_load_link(spark, d):
    """A business-vault link of which one part is loaded already."""
    _views(spark, d)
    staged = stage_bv_link(spark, BV_L_ORDER, _LINK_SRC, RUN)
    old = staged.where(F.col("priority_ck") < "3").select(BV_L_ORDER.hk)
    return link_delta(staged, old, BV_L_ORDER, RUN)
