"""Checked queries: link staging and link loads."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..operators.load import link_delta
from ..operators.stage import stage_link
from ..spec import Link, Source
from . import sqltext as S
from .model import (
    L_COMPOSITE,
    L_LINEITEM,
    L_MISSING,
    L_ORDER_SUPPLIER,
    RUN,
    RUN_OLD,
    RUN_STRICT,
    SHIP_SPLIT,
    T_OLD,
    T_RUN,
    table,
)
from .registry import register

LINEITEM_COLUMNS = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"}


def link_stage_sql(link: Link, src: Source, frm: str, load_ts: str = T_RUN, columns=LINEITEM_COLUMNS,
                   business: bool = False, strict: bool = False) -> str:
    by_key: dict[str, list[str]] = {}
    for c, k in src.bks.items():
        by_key.setdefault(k, []).append(c)
    parts = {}
    for k in link.hks:
        cols = by_key.get(k, [])
        if not cols or cols[0] not in columns:
            parts[k] = [S.q(S.ZERO_KEY)]
        else:
            parts[k] = [S.kt(c) if c in columns else S.q(S.ZERO_KEY) for c in cols]
    flat = [p for k in link.hks for p in parts[k]]
    hubs = [
        (S.md5_plain(parts[k]) if business and not strict else S.hk(parts[k], src.tenant, src.bkeycode)) + f" AS {k}"
        for k in link.hks
    ]
    cks = [(S.kt(c) if c in columns else S.q(S.ZERO_KEY)) + f" AS {t}" for c, t in link.cks.items()]
    return (
        f"SELECT {S.hk(flat, src.tenant, src.bkeycode)} AS {link.hk}, {', '.join([*hubs, *cks])}, "
        f"{S.meta(load_ts, src.name, 'stage_' + link.name, tenant=src.tenant, code=src.bkeycode)} FROM {frm}"
    )


def link_load_sql(link: Link, stage_cte: str, exists_ctes: list[str], strict: bool = False) -> str:
    cks = list(link.cks.values())
    keys = [link.hk, *cks] if strict else [link.hk]
    conds = " AND ".join(
        "NOT EXISTS (SELECT 1 FROM {c} t WHERE {on})".format(c=c, on=" AND ".join(f"t.{k} = s.{k}" for k in keys))
        for c in exists_ctes
    ) or "TRUE"
    cols = ", ".join(f"s.{c}" for c in [link.hk, *link.hks, *cks])
    return (
        f"SELECT {'DISTINCT ' if strict else ''}{cols}, {S.load_meta(T_RUN, 'load_' + link.name)} "
        f"FROM {stage_cte} s WHERE {conds}"
    )


_SRC = L_LINEITEM.sources[0]
_OLD_LINES = f"lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}"


def _old_lines(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz"))


# ------------------------------------------------------------- staging
@register("stage_link_lineitem", link_stage_sql(L_LINEITEM, _SRC, "lineitem"))
def stage_link_lineitem(spark, d):
    return stage_link(table(spark, d, "lineitem"), L_LINEITEM, _SRC, RUN)


@register("stage_link_missing_column", link_stage_sql(L_MISSING, L_MISSING.sources[0], "lineitem"))
def stage_link_missing_column(spark, d):
    return stage_link(table(spark, d, "lineitem"), L_MISSING, L_MISSING.sources[0], RUN)


@register("stage_link_composite", link_stage_sql(L_COMPOSITE, L_COMPOSITE.sources[0], "lineitem"))
def stage_link_composite(spark, d):
    return stage_link(table(spark, d, "lineitem"), L_COMPOSITE, L_COMPOSITE.sources[0], RUN)


# ---------------------------------------------------------------- loads
@register("load_link_first", f"WITH s AS ({link_stage_sql(L_LINEITEM, _SRC, 'lineitem')}) "
          + link_load_sql(L_LINEITEM, "s", []))
def load_link_first(spark, d):
    return link_delta(stage_link(table(spark, d, "lineitem"), L_LINEITEM, _SRC, RUN), None, L_LINEITEM, RUN)


@register("load_link_incremental",
          f"WITH tgt AS ({link_stage_sql(L_LINEITEM, _SRC, _OLD_LINES, T_OLD)}), "
          f"s AS ({link_stage_sql(L_LINEITEM, _SRC, 'lineitem')}) " + link_load_sql(L_LINEITEM, "s", ["tgt"]))
def load_link_incremental(spark, d):
    old = link_delta(stage_link(_old_lines(spark, d), L_LINEITEM, _SRC, RUN_OLD), None, L_LINEITEM, RUN_OLD)
    st = stage_link(table(spark, d, "lineitem"), L_LINEITEM, _SRC, RUN)
    return link_delta(st, old, L_LINEITEM, RUN)


_OS_SRC = L_ORDER_SUPPLIER.sources[0]
_CK_CTES = (
    f"WITH tgt AS ({link_stage_sql(L_ORDER_SUPPLIER, _OS_SRC, _OLD_LINES, T_OLD)}), "
    f"s AS ({link_stage_sql(L_ORDER_SUPPLIER, _OS_SRC, 'lineitem')}) "
)


def _child_key_load(spark, d, run, run_old):
    old_stage = stage_link(_old_lines(spark, d), L_ORDER_SUPPLIER, _OS_SRC, run_old)
    old = link_delta(old_stage, None, L_ORDER_SUPPLIER, run_old)
    st = stage_link(table(spark, d, "lineitem"), L_ORDER_SUPPLIER, _OS_SRC, run)
    return link_delta(st, old, L_ORDER_SUPPLIER, run)


@register("load_link_new_child_key", _CK_CTES + link_load_sql(L_ORDER_SUPPLIER, "s", ["tgt"]))
def load_link_new_child_key(spark, d):
    return _child_key_load(spark, d, RUN, RUN_OLD)


@register("strict_link_new_child_key", _CK_CTES + link_load_sql(L_ORDER_SUPPLIER, "s", ["tgt"], strict=True))
def strict_link_new_child_key(spark, d):
    from .model import RUN_OLD_STRICT

    return _child_key_load(spark, d, RUN_STRICT, RUN_OLD_STRICT)
