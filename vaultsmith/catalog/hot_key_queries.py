"""Checked queries with one hot hash key: the order key of every returned
line (a third of all lineitem rows) is NULL, so all of those rows share the
zero-key hash. Same loaders, same oracle forms; the plans must not funnel
the hot key through a single task (see README, "Skew")."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.load import hub_delta, link_delta, sat_delta
from ..operators.stage import stage_hub, stage_link, stage_sat
from ..run import Run
from ..spec import Hub, Sat, Source
from .hub_queries import hub_load_sql, hub_stage_sql
from .link_queries import link_load_sql, link_stage_sql
from .model import L_LINEITEM, RUN, RUN_OLD, S_LINE, S_ORDER_PARTS, SHIP_SPLIT, T_OLD, T_RUN, table
from . import sqltext as S
from .registry import register
from .sat_queries import sat_ckey_load_sql, sat_multiactive_load_sql, sat_regular_load_sql, sat_stage_sql

HOT_FROM = (
    "(SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS l_orderkey) "
    "FROM lineitem) hot"
)
HOT_OLD_FROM = (
    "(SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS l_orderkey) "
    f"FROM lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}) hot_old"
)


def hot_lines(spark, d, old: bool = False):
    li = table(spark, d, "lineitem")
    if old:
        li = li.where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz"))
    return li.withColumn("l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")))


H_ORDER_FROM_LINES = Hub("h_order", "hk_order", "order_bk", [Source("lineitem", bks=["l_orderkey"])])
_HSRC = H_ORDER_FROM_LINES.sources[0]


@register("load_hub_hot_key",
          f"WITH tgt AS ({hub_stage_sql(H_ORDER_FROM_LINES, _HSRC, HOT_OLD_FROM, T_OLD)}), "
          f"s AS ({hub_stage_sql(H_ORDER_FROM_LINES, _HSRC, HOT_FROM)}) "
          + hub_load_sql(H_ORDER_FROM_LINES, "s", ["tgt"]))
def load_hub_hot_key(spark, d):
    old = stage_hub(hot_lines(spark, d, old=True), H_ORDER_FROM_LINES, _HSRC, RUN_OLD)
    st = stage_hub(hot_lines(spark, d), H_ORDER_FROM_LINES, _HSRC, RUN)
    return hub_delta(st, hub_delta(old, None, H_ORDER_FROM_LINES, RUN_OLD), H_ORDER_FROM_LINES, RUN)


_LSRC = L_LINEITEM.sources[0]


@register("load_link_hot_key",
          f"WITH tgt AS ({link_stage_sql(L_LINEITEM, _LSRC, HOT_OLD_FROM, T_OLD)}), "
          f"s AS ({link_stage_sql(L_LINEITEM, _LSRC, HOT_FROM)}) " + link_load_sql(L_LINEITEM, "s", ["tgt"]))
def load_link_hot_key(spark, d):
    old = link_delta(stage_link(hot_lines(spark, d, old=True), L_LINEITEM, _LSRC, RUN_OLD), None, L_LINEITEM,
                     RUN_OLD)
    return link_delta(stage_link(hot_lines(spark, d), L_LINEITEM, _LSRC, RUN), old, L_LINEITEM, RUN)


_CSRC = S_LINE.sources[0]


@register("load_sat_ckey_hot_key",
          f"WITH os AS ({sat_stage_sql(S_LINE, _CSRC, HOT_OLD_FROM, T_OLD)}), "
          f"tgt AS ({sat_ckey_load_sql(S_LINE, 'os', None, T_OLD)}), "
          f"s AS ({sat_stage_sql(S_LINE, _CSRC, HOT_FROM)}) " + sat_ckey_load_sql(S_LINE, "s", "tgt"))
def load_sat_ckey_hot_key(spark, d):
    old = sat_delta(stage_sat(hot_lines(spark, d, old=True), S_LINE, _CSRC, RUN_OLD), None, S_LINE, RUN_OLD)
    return sat_delta(stage_sat(hot_lines(spark, d), S_LINE, _CSRC, RUN), old, S_LINE, RUN)


_MSRC = S_ORDER_PARTS.sources[0]


@register("load_sat_multiactive_hot_key",
          f"WITH os AS ({sat_stage_sql(S_ORDER_PARTS, _MSRC, HOT_OLD_FROM, T_OLD)}), "
          f"tgt AS ({sat_multiactive_load_sql(S_ORDER_PARTS, 'os', None, T_OLD)}), "
          f"s AS ({sat_stage_sql(S_ORDER_PARTS, _MSRC, HOT_FROM)}) "
          + sat_multiactive_load_sql(S_ORDER_PARTS, "s", "tgt", T_RUN))
def load_sat_multiactive_hot_key(spark, d):
    r_old = Run(load_ts=T_OLD)
    old = sat_delta(stage_sat(hot_lines(spark, d, old=True), S_ORDER_PARTS, _MSRC, r_old), None, S_ORDER_PARTS,
                    r_old)
    return sat_delta(stage_sat(hot_lines(spark, d), S_ORDER_PARTS, _MSRC, RUN), old, S_ORDER_PARTS, RUN)


# Regular satellite keyed by order: the hot key's rows carry distinct attributes.
S_LINE_REGULAR = Sat(
    "s_line_regular", hk="hk_order", attrs=["quantity", "price", "shipdate"],
    sources=[Source("lineitem", bks=["l_orderkey"], attrs={
        "l_quantity": "quantity", "l_extendedprice": "price", "l_shipdate": "shipdate"})],
)
_RSRC = S_LINE_REGULAR.sources[0]


@register("load_sat_regular_hot_key",
          f"WITH os AS ({sat_stage_sql(S_LINE_REGULAR, _RSRC, HOT_OLD_FROM, T_OLD)}), "
          f"tgt AS ({sat_regular_load_sql(S_LINE_REGULAR, 'os', None, T_OLD)}), "
          f"s AS ({sat_stage_sql(S_LINE_REGULAR, _RSRC, HOT_FROM)}) "
          + sat_regular_load_sql(S_LINE_REGULAR, "s", "tgt"))
def load_sat_regular_hot_key(spark, d):
    old = sat_delta(stage_sat(hot_lines(spark, d, old=True), S_LINE_REGULAR, _RSRC, RUN_OLD), None,
                    S_LINE_REGULAR, RUN_OLD)
    return sat_delta(stage_sat(hot_lines(spark, d), S_LINE_REGULAR, _RSRC, RUN), old, S_LINE_REGULAR, RUN)
