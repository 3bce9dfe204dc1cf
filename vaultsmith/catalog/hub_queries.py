"""Checked queries: hub staging and hub loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.load import hub_delta
from ..operators.stage import stage_hub
from ..spec import Hub, Source
from . import sqltext as S
from .model import (
    H_CUSTOMER,
    H_CUSTOMER_2SRC,
    H_LINE,
    ORDER_SPLIT,
    RUN,
    RUN_OLD,
    RUN_STRICT,
    SRC_CUSTOMER,
    SRC_ORDERS_CUST,
    T_OLD,
    T_RUN,
    table,
)
from .registry import register


# ------------------------------------------------------------ SQL builders
def hub_stage_sql(hub: Hub, src: Source, frm: str, load_ts: str = T_RUN, cols: dict | None = None) -> str:
    """The staged rows of ``src`` as SQL; ``cols`` overrides a key column by an expression."""
    cols = cols or {}
    parts = [S.kt(cols.get(b, b)) for b in src.bks]
    return (
        f"SELECT {S.hk(parts, src.tenant, src.bkeycode)} AS {hub.hk}, {S.cws(parts)} AS {hub.bk}, "
        f"{S.meta(load_ts, src.name, 'stage_' + hub.name, tenant=src.tenant, code=src.bkeycode)} FROM {frm}"
    )


def hub_load_sql(hub: Hub, stage_cte: str, exists_ctes: list[str], distinct: bool = False) -> str:
    """``INSERT ... SELECT`` body: staged rows whose hk is in none of ``exists_ctes``."""
    conds = " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM {c} t WHERE t.{hub.hk} = s.{hub.hk})" for c in exists_ctes
    ) or "TRUE"
    return (
        f"SELECT {'DISTINCT ' if distinct else ''}s.{hub.hk}, s.{hub.bk}, "
        f"{S.load_meta(T_RUN, 'load_' + hub.name)} FROM {stage_cte} s WHERE {conds}"
    )


# Target of the incremental loads: customers of two segments, loaded earlier.
_OLD_SEGMENTS = ("BUILDING", "MACHINERY")
_OLD_CUSTOMERS = f"customer WHERE c_mktsegment IN ({', '.join(S.q(x) for x in _OLD_SEGMENTS)})"


def _old_customer_hub(spark, d):
    cust = table(spark, d, "customer").where(F.col("c_mktsegment").isin(*_OLD_SEGMENTS))
    return hub_delta(stage_hub(cust, H_CUSTOMER, SRC_CUSTOMER, RUN_OLD), None, H_CUSTOMER, RUN_OLD)


# ------------------------------------------------------------- staging
@register("stage_hub_customer", hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, "customer"))
def stage_hub_customer(spark, d):
    return stage_hub(table(spark, d, "customer"), H_CUSTOMER, SRC_CUSTOMER, RUN)


# Composite key (order, line number) with NULL line numbers -> zero key.
_LINE_SRC = H_LINE.sources[0]
_NULLED_LINE = "nullif(l_linenumber, 1)"


@register("stage_hub_composite_zero_key",
          hub_stage_sql(H_LINE, _LINE_SRC, "lineitem", cols={"l_linenumber": _NULLED_LINE}))
def stage_hub_composite_zero_key(spark, d):
    li = table(spark, d, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_linenumber") != 1, F.col("l_linenumber"))
    )
    return stage_hub(li, H_LINE, _LINE_SRC, RUN)


# ---------------------------------------------------------------- loads
@register("load_hub_first", f"WITH s AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, 'customer')}) "
          + hub_load_sql(H_CUSTOMER, "s", []))
def load_hub_first(spark, d):
    st = stage_hub(table(spark, d, "customer"), H_CUSTOMER, SRC_CUSTOMER, RUN)
    return hub_delta(st, None, H_CUSTOMER, RUN)


_INCR_SQL = (
    f"WITH tgt AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, _OLD_CUSTOMERS, T_OLD)}), "
    f"s AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, 'customer')}) " + hub_load_sql(H_CUSTOMER, "s", ["tgt"])
)


@register("load_hub_incremental", _INCR_SQL)
def load_hub_incremental(spark, d):
    st = stage_hub(table(spark, d, "customer"), H_CUSTOMER, SRC_CUSTOMER, RUN)
    return hub_delta(st, _old_customer_hub(spark, d), H_CUSTOMER, RUN)


# Hub fed from a fact table: every order repeats its customer key.
_H_CUST_FROM_ORDERS = Hub("h_customer", "hk_customer", "customer_bk", [SRC_ORDERS_CUST])
_OLD_ORDERS = f"orders WHERE o_orderdate < {S.ts(ORDER_SPLIT + ' 00:00:00')}"


def _old_hub_from_orders(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderdate") < F.lit(ORDER_SPLIT).cast("timestamp_ntz"))
    return hub_delta(stage_hub(o, _H_CUST_FROM_ORDERS, SRC_ORDERS_CUST, RUN_OLD), None, _H_CUST_FROM_ORDERS, RUN_OLD)


_DUP_SQL_CTES = (
    f"WITH tgt AS ({hub_stage_sql(_H_CUST_FROM_ORDERS, SRC_ORDERS_CUST, _OLD_ORDERS, T_OLD)}), "
    f"s AS ({hub_stage_sql(_H_CUST_FROM_ORDERS, SRC_ORDERS_CUST, 'orders')}) "
)


@register("load_hub_duplicates", _DUP_SQL_CTES + hub_load_sql(_H_CUST_FROM_ORDERS, "s", ["tgt"]))
def load_hub_duplicates(spark, d):
    st = stage_hub(table(spark, d, "orders"), _H_CUST_FROM_ORDERS, SRC_ORDERS_CUST, RUN)
    return hub_delta(st, _old_hub_from_orders(spark, d), _H_CUST_FROM_ORDERS, RUN)


@register("strict_hub_duplicates", _DUP_SQL_CTES + hub_load_sql(_H_CUST_FROM_ORDERS, "s", ["tgt"], distinct=True))
def strict_hub_duplicates(spark, d):
    st = stage_hub(table(spark, d, "orders"), _H_CUST_FROM_ORDERS, SRC_ORDERS_CUST, RUN_STRICT)
    return hub_delta(st, _old_hub_from_orders(spark, d), _H_CUST_FROM_ORDERS, RUN_STRICT)


# Two sources, one hub: each source loads only keys no earlier source had.
_OLD_BUILDING = "customer WHERE c_mktsegment = 'BUILDING'"


def _multi_source_sql(first: Source, second: Source) -> str:
    frm = {"customer": "customer", "orders": "orders"}
    return (
        f"WITH tgt AS ({hub_stage_sql(H_CUSTOMER, SRC_CUSTOMER, _OLD_BUILDING, T_OLD)}), "
        f"s1 AS ({hub_stage_sql(H_CUSTOMER_2SRC, first, frm[first.name])}), "
        f"s2 AS ({hub_stage_sql(H_CUSTOMER_2SRC, second, frm[second.name])}) "
        f"{hub_load_sql(H_CUSTOMER_2SRC, 's1', ['tgt'])} UNION ALL "
        f"{hub_load_sql(H_CUSTOMER_2SRC, 's2', ['tgt', 's1'])}"
    )


def _multi_source(spark, d, first: Source, second: Source):
    hub = H_CUSTOMER_2SRC
    old = table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    tgt = hub_delta(stage_hub(old, H_CUSTOMER, SRC_CUSTOMER, RUN_OLD), None, H_CUSTOMER, RUN_OLD)
    stages = [stage_hub(table(spark, d, s.name), hub, s, RUN) for s in (first, second)]
    return hub_delta(stages, tgt, hub, RUN)


@register("load_hub_multi_source", _multi_source_sql(SRC_CUSTOMER, SRC_ORDERS_CUST))
def load_hub_multi_source(spark, d):
    return _multi_source(spark, d, SRC_CUSTOMER, SRC_ORDERS_CUST)


@register("load_hub_multi_source_fact_first", _multi_source_sql(SRC_ORDERS_CUST, SRC_CUSTOMER))
def load_hub_multi_source_fact_first(spark, d):
    return _multi_source(spark, d, SRC_ORDERS_CUST, SRC_CUSTOMER)
