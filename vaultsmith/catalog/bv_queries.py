"""Checked queries: business-vault staging and loads from Spark SQL sources.

The virtual-source SQL runs unchanged in Spark (over temporary views of the
test tables) and in DuckDB, where it is embedded as a derived table.
"""

from __future__ import annotations

from ..operators.load import hub_delta, sat_delta
from ..operators.stage import stage_bv_hub, stage_bv_link, stage_bv_sat
from ..run import Run
from ..sources.tables import parquet_sources, register_views
from ..spec import Hub, Link, Sat, Source
from . import sqltext as S
from .hub_queries import hub_load_sql
from .link_queries import link_stage_sql
from .model import RUN, RUN_STRICT, T_OLD, T_RUN
from .registry import register
from .sat_queries import sat_ckey_load_sql, sat_stage_sql

VIEWS = ["orders", "customer", "nation"]

# Virtual sources: joins of orders, customer and nation.
SQL_SEGMENT_NATION = (
    "SELECT c.c_custkey, c.c_mktsegment, n.n_name FROM customer c "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey"
)
SQL_ORDER_CUSTOMER = (
    "SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderdate, c.c_name, n.n_name "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey"
)
# Same, with NULL child keys for one priority.
SQL_ORDER_NULL_CK = (
    "SELECT o.o_orderkey, nullif(o.o_orderpriority, '5-LOW') AS o_orderpriority, "
    "o.o_orderdate, c.c_name, n.n_name "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey"
)

BV_H_SEGMENT = Hub(
    "bv_h_segment_nation", hk="hk_segment_nation", bk="segment_nation_bk",
    sources=[Source("segment_nation_sql", bks=["n_name", "c_mktsegment"], sql=SQL_SEGMENT_NATION)],
)
BV_L_ORDER = Link(
    "bv_l_order_customer", hk="hk_order_customer", hks=["hk_order", "hk_customer", "hk_nation"],
    cks={"o_orderpriority": "priority_ck"},
    sources=[Source("order_customer_sql", bks={"o_orderkey": "hk_order", "o_custkey": "hk_customer",
                                               "n_name": "hk_nation"}, sql=SQL_ORDER_CUSTOMER)],
)
BV_S_ORDER = Sat(
    "bv_s_order", hk="hk_order", attrs=["customer_name", "nation", "orderdate"],
    cks={"o_orderpriority": "priority_ck"},
    sources=[Source("order_sql", bks=["o_orderkey"],
                    attrs={"c_name": "customer_name", "n_name": "nation", "o_orderdate": "orderdate"},
                    sql=SQL_ORDER_NULL_CK)],
)


def _views(spark, d):
    register_views(spark, parquet_sources(spark, d), VIEWS)


def _from(sql: str) -> str:
    return f"({sql}) custom_sql"


_HUB_SRC = BV_H_SEGMENT.sources[0]
_LINK_SRC = BV_L_ORDER.sources[0]
_SAT_SRC = BV_S_ORDER.sources[0]
_ORDER_CUST_COLS = {"o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "c_name", "n_name"}


def _bv_hub_stage_sql(load_ts: str = T_RUN) -> str:
    parts = [S.kt(b) for b in _HUB_SRC.bks]
    return (
        f"SELECT {S.hk(parts)} AS {BV_H_SEGMENT.hk}, {S.cws(parts)} AS {BV_H_SEGMENT.bk}, "
        f"{S.meta(load_ts, _HUB_SRC.name, 'stage_' + BV_H_SEGMENT.name)} FROM {_from(SQL_SEGMENT_NATION)}"
    )


@register("bv_stage_hub", _bv_hub_stage_sql())
def bv_stage_hub(spark, d):
    _views(spark, d)
    return stage_bv_hub(spark, BV_H_SEGMENT, _HUB_SRC, RUN)


@register("bv_load_hub",
          f"WITH s AS ({_bv_hub_stage_sql()}) " + hub_load_sql(BV_H_SEGMENT, "s", []))
def bv_load_hub(spark, d):
    """Business-vault hub, first load: every staged row of a new key."""
    _views(spark, d)
    return hub_delta(stage_bv_hub(spark, BV_H_SEGMENT, _HUB_SRC, RUN), None, BV_H_SEGMENT, RUN)


@register("bv_stage_link",
          link_stage_sql(BV_L_ORDER, _LINK_SRC, _from(SQL_ORDER_CUSTOMER), columns=_ORDER_CUST_COLS, business=True))
def bv_stage_link(spark, d):
    """Hub keys inside a business-vault link are unsalted md5(key)."""
    _views(spark, d)
    return stage_bv_link(spark, BV_L_ORDER, _LINK_SRC, RUN)


@register("strict_bv_stage_link",
          link_stage_sql(BV_L_ORDER, _LINK_SRC, _from(SQL_ORDER_CUSTOMER), columns=_ORDER_CUST_COLS,
                         business=True, strict=True))
def strict_bv_stage_link(spark, d):
    _views(spark, d)
    return stage_bv_link(spark, BV_L_ORDER, _LINK_SRC, RUN_STRICT)


@register("bv_stage_sat", sat_stage_sql(BV_S_ORDER, _SAT_SRC, _from(SQL_ORDER_NULL_CK), business=True))
def bv_stage_sat(spark, d):
    """Raw child keys (NULL stays NULL); the hashdiff hashes trimmed texts."""
    _views(spark, d)
    return stage_bv_sat(spark, BV_S_ORDER, _SAT_SRC, RUN)


@register("strict_bv_stage_sat",
          sat_stage_sql(BV_S_ORDER, _SAT_SRC, _from(SQL_ORDER_NULL_CK), business=True, strict=True,
                        columns=["c_name", "n_name", "o_orderdate"]))
def strict_bv_stage_sat(spark, d):
    """Strict: child keys are trimmed and zero-keyed, attributes trimmed, NULLs kept apart in the hashdiff."""
    _views(spark, d)
    return stage_bv_sat(spark, BV_S_ORDER, _SAT_SRC, RUN_STRICT)


def _bv_ckey_sql() -> str:
    return (
        f"WITH os AS ({sat_stage_sql(BV_S_ORDER, _SAT_SRC, _from(SQL_ORDER_NULL_CK), T_OLD, business=True)}), "
        f"tgt AS ({sat_ckey_load_sql(BV_S_ORDER, 'os', None, T_OLD)}), "
        f"s AS ({sat_stage_sql(BV_S_ORDER, _SAT_SRC, _from(SQL_ORDER_NULL_CK), business=True)}) "
        + sat_ckey_load_sql(BV_S_ORDER, "s", "tgt")
    )


@register("bv_load_sat_ckey_reload", _bv_ckey_sql())
def bv_load_sat_ckey_reload(spark, d):
    """The same business-vault stage loaded twice: rows with a NULL child key
    never match the target and load again; all others are already there."""
    _views(spark, d)
    r_old = Run(load_ts=T_OLD)
    old = sat_delta(stage_bv_sat(spark, BV_S_ORDER, _SAT_SRC, r_old), None, BV_S_ORDER, r_old)
    st = stage_bv_sat(spark, BV_S_ORDER, _SAT_SRC, RUN)
    return sat_delta(st, old, BV_S_ORDER, RUN)
