"""Checked queries: satellite staging and satellite loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.load import sat_delta
from ..operators.stage import stage_sat
from ..run import Run
from ..spec import Sat, Source
from . import sqltext as S
from .model import (
    RUN,
    RUN_OLD,
    RUN_OLD_STRICT,
    RUN_STRICT,
    S_CUSTOMER,
    S_LINE,
    S_ORDER,
    S_ORDER_PARTS,
    S_ORDER_SWAPPED,
    SHIP_SPLIT,
    T_MID,
    T_OLD,
    T_RUN,
    table,
)
from .registry import register


# ------------------------------------------------------------ SQL builders
# The source column behind every attribute, in attribute order: (reference, strict).
SOURCE_COLUMNS = {
    "s_customer": (["c_name", "c_acctbal", "c_mktsegment"],) * 2,
    "s_order": (["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],) * 2,
    # attrs [status, priority], mapped priority first: by position the values swap.
    "s_order_swapped": (["o_orderpriority", "o_orderstatus"], ["o_orderstatus", "o_orderpriority"]),
    "s_lineitem": (["l_quantity", "l_extendedprice", "l_shipdate"],) * 2,
    "s_order_parts": (["l_partkey", "l_quantity"],) * 2,
    "s_line_regular": (["l_quantity", "l_extendedprice", "l_shipdate"],) * 2,
    "bv_s_order": (["c_name", "n_name", "o_orderdate"],) * 2,
    "s_document": (["text", "lang"],) * 2,
}


def sat_stage_sql(sat: Sat, src: Source, frm: str, load_ts: str = T_RUN, business: bool = False,
                  strict: bool = False, present: set[str] | None = None, columns: list[str] | None = None,
                  applied_ts: str | None = None) -> str:
    """Staged satellite rows as SQL; ``columns`` are the attributes' source columns."""
    columns = columns or SOURCE_COLUMNS[sat.name][1 if strict else 0]
    key = [S.whole_kt(b) if strict else S.kt(b) for b in src.bks]
    cks = []
    for c, t in sat.cks.items():
        if strict and (present is None or c in present):
            e = S.whole_kt(c)
        elif business and not strict:
            e = S.txt(c)
        else:
            e = S.q(S.ZERO_KEY)
        cks.append(f"{e} AS {t}")
    raw = [S.txt(c) for c in columns]
    if strict:
        vals = [f"trim({r})" for r in raw]
        diff = S.md5_plain([f"coalesce({v}, '')" for v in vals])
    elif business:
        vals = raw
        diff = S.md5_plain([f"trim({S.bounded(r)})" for r in raw])
    else:
        vals = raw
        diff = S.md5_plain(raw)
    attrs = [f"{v} AS {t}" for v, t in zip(vals, sat.attrs)]
    return (
        f"SELECT {S.hk(key, src.tenant, src.bkeycode)} AS {sat.hk}, {', '.join([*cks, *attrs])}, "
        f"{diff} AS dv_hashdiff, "
        f"{S.meta(load_ts, src.name, 'stage_' + sat.name, applied_ts, src.tenant, src.bkeycode)} FROM {frm}"
    )


def _sat_row(sat: Sat, load_ts: str, alias: str = "s") -> str:
    cols = [sat.hk, *sat.cks.values(), *sat.attrs, "dv_hashdiff"]
    return ", ".join(f"{alias}.{c}" for c in cols) + ", " + S.load_meta(load_ts, "load_" + sat.name, alias)


def sat_regular_load_sql(sat: Sat, stage_cte: str, target_cte: str | None, load_ts: str = T_RUN) -> str:
    where = f"WHERE s.{sat.hk} NOT IN (SELECT {sat.hk} FROM {target_cte})" if target_cte else ""
    return f"SELECT DISTINCT {_sat_row(sat, load_ts)} FROM {stage_cte} s {where}"


def sat_ckey_load_sql(sat: Sat, stage_cte: str, target_cte: str | None, load_ts: str = T_RUN) -> str:
    """Each key's hashdiffs at its newest time as a list; staged rows that are not on it."""
    if not target_cte:
        return f"SELECT DISTINCT {_sat_row(sat, load_ts)} FROM {stage_cte} s"
    key = ", ".join([sat.hk, *sat.cks.values()])
    timed = f"SELECT {key}, dv_hashdiff, {S.newest()} AS moment FROM {target_cte}"
    listed = (f"SELECT {key}, list(dv_hashdiff) FILTER (moment = last_moment) AS known FROM "
              f"(SELECT *, max(moment) OVER (PARTITION BY {key}) AS last_moment FROM ({timed})) GROUP BY {key}")
    return (f"SELECT DISTINCT {_sat_row(sat, load_ts)} FROM {stage_cte} s LEFT JOIN ({listed}) k USING ({key}) "
            f"WHERE NOT coalesce(list_contains(k.known, s.dv_hashdiff), false)")


def sat_multiactive_load_sql(sat: Sat, stage_cte: str, target_cte: str | None, load_ts: str = T_RUN,
                             strict: bool = False) -> str:
    """Sets as sorted lists: a key reloads unless its staged list has the current set's
    size and lies in it; ``dv_subseq`` is a hashdiff's place on the staged list."""
    hk = sat.hk
    src = f"(SELECT DISTINCT * FROM {stage_cte})" if strict else stage_cte
    attrs = ", ".join(f"s.{a}" for a in sat.attrs)
    staged = f"SELECT {hk}, list_sort(list(DISTINCT dv_hashdiff)) AS hashes FROM {stage_cte} GROUP BY {hk}"
    out = (
        f"SELECT s.{hk}, {attrs}, s.dv_hashdiff, s.dv_loadts, s.dv_appts, s.dv_recsrc, s.dv_tenant, s.dv_bkeycode, "
        f"list_position(n.hashes, s.dv_hashdiff)::INTEGER AS dv_subseq, {S.q('load_' + sat.name)} AS dv_taskid "
        f"FROM {src} s JOIN ({staged}) n USING ({hk})"
    )
    if not target_cte:
        return out
    timed = f"SELECT *, {S.newest()} AS moment FROM {target_cte}"
    current = (f"SELECT {hk}, list(dv_hashdiff) AS known, max(dv_subseq) AS size, "
               f"bool_and(dv_appts IS NOT NULL AND dv_loadts IS NOT NULL) AS comparable FROM "
               f"(SELECT *, max(moment) OVER (PARTITION BY {hk}) AS last_moment FROM ({timed})) WHERE moment = last_moment GROUP BY {hk}")
    return (f"{out} LEFT JOIN ({current}) c USING ({hk}) WHERE NOT coalesce("
            f"c.comparable AND c.size = len(n.hashes) AND list_has_all(c.known, n.hashes), false)")


def ts_lit(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ===================================================================== staging
_ORD_SRC = S_ORDER.sources[0]


@register("stage_sat_orders", sat_stage_sql(S_ORDER, _ORD_SRC, "orders"))
def stage_sat_orders(spark, d):
    return stage_sat(table(spark, d, "orders"), S_ORDER, _ORD_SRC, RUN)


# Padded text and NULL attributes: raw-vault attributes and hashdiff are not
# trimmed, and NULLs are skipped inside the hashdiff.
_PADDED_FROM = (
    "(SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, "
    "concat('  ', o_orderpriority, ' ') AS o_orderpriority, o_totalprice, o_orderdate FROM orders) p"
)


def _padded_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("o_orderpriority"),
        "o_totalprice",
        "o_orderdate",
    )


_SW_SRC = S_ORDER_SWAPPED.sources[0]


@register("stage_sat_padded", sat_stage_sql(S_ORDER_SWAPPED, _SW_SRC, _PADDED_FROM))
def stage_sat_padded(spark, d):
    return stage_sat(_padded_orders(spark, d), S_ORDER_SWAPPED, _SW_SRC, RUN)


@register("strict_stage_sat_padded", sat_stage_sql(S_ORDER_SWAPPED, _SW_SRC, _PADDED_FROM, strict=True))
def strict_stage_sat_padded(spark, d):
    return stage_sat(_padded_orders(spark, d), S_ORDER_SWAPPED, _SW_SRC, RUN_STRICT)


_LINE_SRC = S_LINE.sources[0]
_LINE_COLS = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_shipdate"}


@register("stage_sat_ckey", sat_stage_sql(S_LINE, _LINE_SRC, "lineitem"))
def stage_sat_ckey(spark, d):
    return stage_sat(table(spark, d, "lineitem"), S_LINE, _LINE_SRC, RUN)


@register("strict_stage_sat_ckey", sat_stage_sql(S_LINE, _LINE_SRC, "lineitem", strict=True, present=_LINE_COLS))
def strict_stage_sat_ckey(spark, d):
    return stage_sat(table(spark, d, "lineitem"), S_LINE, _LINE_SRC, RUN_STRICT)


# ============================================================ regular loads
_CUST_SRC = S_CUSTOMER.sources[0]
_OLD_SEGMENTS = ("BUILDING", "MACHINERY")
# Earlier load of two segments, with names that have changed since.
_OLD_CUST_FROM = (
    "(SELECT c_custkey, concat(c_name, ' (old)') AS c_name, c_acctbal, c_mktsegment FROM customer "
    f"WHERE c_mktsegment IN ({', '.join(S.q(x) for x in _OLD_SEGMENTS)})) oc"
)


def _old_customers(spark, d):
    c = table(spark, d, "customer").where(F.col("c_mktsegment").isin(*_OLD_SEGMENTS))
    return c.withColumn("c_name", F.concat(F.col("c_name"), F.lit(" (old)")))


def _regular_sql(strict: bool) -> str:
    old_stage = sat_stage_sql(S_CUSTOMER, _CUST_SRC, _OLD_CUST_FROM, T_OLD, strict=strict)
    new_stage = sat_stage_sql(S_CUSTOMER, _CUST_SRC, "customer", strict=strict)
    head = (
        f"WITH os AS ({old_stage}), tgt AS ({sat_regular_load_sql(S_CUSTOMER, 'os', None, T_OLD)}), "
        f"s AS ({new_stage}) "
    )
    if strict:
        return head + sat_ckey_load_sql(S_CUSTOMER, "s", "tgt")
    return head + sat_regular_load_sql(S_CUSTOMER, "s", "tgt")


def _regular(spark, d, run: Run, run_old: Run):
    old = sat_delta(stage_sat(_old_customers(spark, d), S_CUSTOMER, _CUST_SRC, run_old), None, S_CUSTOMER, run_old)
    st = stage_sat(table(spark, d, "customer"), S_CUSTOMER, _CUST_SRC, run)
    return sat_delta(st, old, S_CUSTOMER, run)


@register("load_sat_regular", _regular_sql(strict=False))
def load_sat_regular(spark, d):
    return _regular(spark, d, RUN, RUN_OLD)


@register("strict_sat_regular", _regular_sql(strict=True))
def strict_sat_regular(spark, d):
    return _regular(spark, d, RUN_STRICT, RUN_OLD_STRICT)


# ============================================================ child-key loads
_OLD_LINES_FROM = f"(SELECT * FROM lineitem WHERE l_shipdate < {S.ts(SHIP_SPLIT + ' 00:00:00')}) ol"
# Version B: returned lines got another quantity, loaded in between.
_B_LINES_FROM = "(SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem WHERE l_returnflag = 'R') bl"


def _old_lines(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_shipdate") < ts_lit(SHIP_SPLIT))


def _b_lines(spark, d):
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return li.withColumn("l_quantity", F.col("l_quantity") + 1)


@register("load_sat_ckey",
          f"WITH os AS ({sat_stage_sql(S_LINE, _LINE_SRC, _OLD_LINES_FROM, T_OLD)}), "
          f"tgt AS ({sat_ckey_load_sql(S_LINE, 'os', None, T_OLD)}), "
          f"s AS ({sat_stage_sql(S_LINE, _LINE_SRC, 'lineitem')}) " + sat_ckey_load_sql(S_LINE, "s", "tgt"))
def load_sat_ckey(spark, d):
    old = sat_delta(stage_sat(_old_lines(spark, d), S_LINE, _LINE_SRC, RUN_OLD), None, S_LINE, RUN_OLD)
    st = stage_sat(table(spark, d, "lineitem"), S_LINE, _LINE_SRC, RUN)
    return sat_delta(st, old, S_LINE, RUN)


def _history_sql(strict: bool, null_appts: bool = False) -> str:
    kw = {"strict": strict, "present": _LINE_COLS}
    a = f"WITH sa AS ({sat_stage_sql(S_LINE, _LINE_SRC, 'lineitem', T_OLD, **kw)}), "
    v1 = sat_ckey_load_sql(S_LINE, "sa", None, T_OLD)
    if null_appts:
        v1 = f"SELECT * REPLACE (CASE WHEN quantity = '1.0' THEN NULL ELSE dv_appts END AS dv_appts) FROM ({v1}) v"
    a += f"v1 AS ({v1}), "
    a += f"sb AS ({sat_stage_sql(S_LINE, _LINE_SRC, _B_LINES_FROM, T_MID, **kw)}), "
    a += f"v2 AS ({sat_ckey_load_sql(S_LINE, 'sb', 'v1', T_MID)}), "
    a += "tgt AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2), "
    a += f"s AS ({sat_stage_sql(S_LINE, _LINE_SRC, 'lineitem', **kw)}) "
    return a + sat_ckey_load_sql(S_LINE, "s", "tgt")


def _history(spark, d, strict: bool, null_appts: bool = False):
    sem = "strict" if strict else "reference"
    r_old, r_mid, r_run = (Run(load_ts=t, semantics=sem) for t in (T_OLD, T_MID, T_RUN))
    li = table(spark, d, "lineitem")
    v1 = sat_delta(stage_sat(li, S_LINE, _LINE_SRC, r_old), None, S_LINE, r_old)
    if null_appts:
        v1 = v1.withColumn("dv_appts", F.when(F.col("quantity") != "1.0", F.col("dv_appts")))
    v2 = sat_delta(stage_sat(_b_lines(spark, d), S_LINE, _LINE_SRC, r_mid), v1, S_LINE, r_mid)
    target = v1.unionByName(v2)
    return sat_delta(stage_sat(li, S_LINE, _LINE_SRC, r_run), target, S_LINE, r_run)


@register("load_sat_ckey_history", _history_sql(strict=False))
def load_sat_ckey_history(spark, d):
    """History A -> B -> A: the last A differs from the latest version B."""
    return _history(spark, d, strict=False)


@register("strict_sat_ckey_history", _history_sql(strict=True))
def strict_sat_ckey_history(spark, d):
    return _history(spark, d, strict=True)


@register("load_sat_ckey_null_appts", _history_sql(strict=True, null_appts=True))
def load_sat_ckey_null_appts(spark, d):
    """A NULL applied time sorts as the newest version."""
    return _history(spark, d, strict=True, null_appts=True)


# ========================================================= multi-active loads
_MA_SRC = S_ORDER_PARTS.sources[0]
_DUP_LINES_FROM = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R') dl"


def _dup_lines(spark, d):
    li = table(spark, d, "lineitem")
    return li.unionByName(li.where(F.col("l_returnflag") == "R"))


def _ma_sql(old_from: str, new_from: str, strict: bool = False, null_appts: bool = False) -> str:
    kw = {"strict": strict}
    first = sat_multiactive_load_sql(S_ORDER_PARTS, "os", None, T_OLD, strict)
    if null_appts:
        first = f"SELECT * REPLACE (CASE WHEN partkey < '500' THEN NULL ELSE dv_appts END AS dv_appts) FROM ({first}) f"
    return (
        f"WITH os AS ({sat_stage_sql(S_ORDER_PARTS, _MA_SRC, old_from, T_OLD, **kw)}), "
        f"tgt AS ({first}), "
        f"s AS ({sat_stage_sql(S_ORDER_PARTS, _MA_SRC, new_from, **kw)}) "
        + sat_multiactive_load_sql(S_ORDER_PARTS, "s", "tgt", T_RUN, strict)
    )


def _ma(old_df, new_df, strict: bool = False, null_appts: bool = False):
    sem = "strict" if strict else "reference"
    r_old, r_run = Run(load_ts=T_OLD, semantics=sem), Run(load_ts=T_RUN, semantics=sem)
    tgt = sat_delta(stage_sat(old_df, S_ORDER_PARTS, _MA_SRC, r_old), None, S_ORDER_PARTS, r_old)
    if null_appts:
        tgt = tgt.withColumn("dv_appts", F.when(~(F.col("partkey") < "500"), F.col("dv_appts")))
    return sat_delta(stage_sat(new_df, S_ORDER_PARTS, _MA_SRC, r_run), tgt, S_ORDER_PARTS, r_run)


@register("load_sat_multiactive_first",
          f"WITH s AS ({sat_stage_sql(S_ORDER_PARTS, _MA_SRC, 'lineitem')}) "
          + sat_multiactive_load_sql(S_ORDER_PARTS, "s", None))
def load_sat_multiactive_first(spark, d):
    st = stage_sat(table(spark, d, "lineitem"), S_ORDER_PARTS, _MA_SRC, RUN)
    return sat_delta(st, None, S_ORDER_PARTS, RUN)


@register("load_sat_multiactive", _ma_sql(_OLD_LINES_FROM, "lineitem"))
def load_sat_multiactive(spark, d):
    """Sets grown since the earlier load are reloaded whole."""
    return _ma(_old_lines(spark, d), table(spark, d, "lineitem"))


@register("load_sat_multiactive_unchanged", _ma_sql("lineitem", "lineitem"))
def load_sat_multiactive_unchanged(spark, d):
    return _ma(table(spark, d, "lineitem"), table(spark, d, "lineitem"))


@register("load_sat_multiactive_shrunk", _ma_sql("lineitem", _OLD_LINES_FROM))
def load_sat_multiactive_shrunk(spark, d):
    """A staged set that is a strict subset of the current one still reloads."""
    return _ma(table(spark, d, "lineitem"), _old_lines(spark, d))


@register("load_sat_multiactive_duplicates", _ma_sql(_OLD_LINES_FROM, _DUP_LINES_FROM))
def load_sat_multiactive_duplicates(spark, d):
    return _ma(_old_lines(spark, d), _dup_lines(spark, d))


@register("strict_sat_multiactive_duplicates", _ma_sql(_OLD_LINES_FROM, _DUP_LINES_FROM, strict=True))
def strict_sat_multiactive_duplicates(spark, d):
    return _ma(_old_lines(spark, d), _dup_lines(spark, d), strict=True)


@register("load_sat_multiactive_null_appts", _ma_sql("lineitem", "lineitem", null_appts=True))
def load_sat_multiactive_null_appts(spark, d):
    """Keys whose newest group has a NULL applied time never match: reloaded."""
    return _ma(table(spark, d, "lineitem"), table(spark, d, "lineitem"), null_appts=True)


# ======================================================== several sources
# A second source re-delivers the returned lines with another quantity.
_CORR_FROM = "(SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem WHERE l_returnflag = 'R') corr"
S_LINE_2SRC = Sat(
    "s_lineitem", hk="hk_order", attrs=["quantity", "price", "shipdate"], cks={"l_linenumber": "linenumber_ck"},
    sources=[_LINE_SRC, Source("lineitem_corrections", bks=["l_orderkey"], attrs=dict(_LINE_SRC.attrs))],
)
S_PARTS_2SRC = Sat(
    "s_order_parts", hk="hk_order", attrs=["partkey", "quantity"], multiactive=True,
    sources=[_MA_SRC, Source("lineitem_corrections", bks=["l_orderkey"], attrs=dict(_MA_SRC.attrs))],
)


def _two_sources_sql(sat: Sat, load_sql, strict: bool = False) -> str:
    s1, s2 = sat.sources
    kw = {"strict": strict}
    head = (
        f"WITH os AS ({sat_stage_sql(sat, s1, _OLD_LINES_FROM, T_OLD, **kw)}), "
        f"tgt AS ({load_sql(sat, 'os', None, T_OLD)}), "
        f"s1 AS ({sat_stage_sql(sat, s1, 'lineitem', **kw)}), "
        f"s2 AS ({sat_stage_sql(sat, s2, _CORR_FROM, **kw)}), "
    )
    if strict and sat.multiactive:
        # Strict multi-active: the union of the sources is one staged set.
        return head + "s AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2) " + load_sql(sat, "s", "tgt", T_RUN)
    return (
        head + f"d1 AS ({load_sql(sat, 's1', 'tgt', T_RUN)}), "
        "t2 AS (SELECT * FROM tgt UNION ALL SELECT * FROM d1), "
        f"d2 AS ({load_sql(sat, 's2', 't2', T_RUN)}) "
        "SELECT * FROM d1 UNION ALL SELECT * FROM d2"
    )


def _two_sources(spark, d, sat: Sat, strict: bool = False):
    sem = "strict" if strict else "reference"
    r_old, r_run = Run(load_ts=T_OLD, semantics=sem), Run(load_ts=T_RUN, semantics=sem)
    s1, s2 = sat.sources
    old = sat_delta(stage_sat(_old_lines(spark, d), sat, s1, r_old), None, sat, r_old)
    stages = [stage_sat(table(spark, d, "lineitem"), sat, s1, r_run), stage_sat(_b_lines(spark, d), sat, s2, r_run)]
    return sat_delta(stages, old, sat, r_run)


def _ma_load(sat, stage_cte, target_cte, load_ts=T_RUN):
    return sat_multiactive_load_sql(sat, stage_cte, target_cte, load_ts)


def _ma_load_strict(sat, stage_cte, target_cte, load_ts=T_RUN):
    return sat_multiactive_load_sql(sat, stage_cte, target_cte, load_ts, strict=True)


@register("load_sat_ckey_multi_source", _two_sources_sql(S_LINE_2SRC, sat_ckey_load_sql))
def load_sat_ckey_multi_source(spark, d):
    """Source 2 compares with the latest rows, including those source 1 added."""
    return _two_sources(spark, d, S_LINE_2SRC)


@register("load_sat_multiactive_multi_source", _two_sources_sql(S_PARTS_2SRC, _ma_load))
def load_sat_multiactive_multi_source(spark, d):
    """Sources load one after another: source 2's smaller sets replace source 1's."""
    return _two_sources(spark, d, S_PARTS_2SRC)


@register("strict_sat_multiactive_multi_source", _two_sources_sql(S_PARTS_2SRC, _ma_load_strict, strict=True))
def strict_sat_multiactive_multi_source(spark, d):
    """Strict: the union of both sources is one staged set per key."""
    return _two_sources(spark, d, S_PARTS_2SRC, strict=True)


# ================================================== long text, booleans, late times
S_DOCUMENT = Sat(
    "s_document", hk="hk_document", attrs=["text", "lang"],
    sources=[Source("documents", bks=["doc_id"], attrs={"text": "text", "lang": "lang"})],
)


@register("strict_stage_sat_long_text",
          "SELECT md5(concat_ws('|', 'default', 'default', coalesce(trim(CAST(doc_id AS VARCHAR)), '-1'))) AS hk_document, "
          "trim(text) AS text, trim(lang) AS lang, md5(coalesce(trim(text), '') || '|' || coalesce(trim(lang), '')) AS dv_hashdiff, "
          + S.meta(T_RUN, "documents", "stage_s_document") + " FROM documents")
def strict_stage_sat_long_text(spark, d):
    """Attributes are never cut: texts of any length, and their hashdiffs, stay whole."""
    return stage_sat(table(spark, d, "documents"), S_DOCUMENT, S_DOCUMENT.sources[0], RUN_STRICT)


S_ORDER_FLAGS = Sat(
    "s_order_flags", hk="hk_order", attrs=["is_open", "priority"],
    sources=[Source("orders", bks=["o_orderkey"], attrs={"is_open": "is_open", "o_orderpriority": "priority"})],
)


@register("stage_sat_boolean",
          "SELECT md5(concat_ws('|', 'default', 'default', CAST(o_orderkey AS VARCHAR))) AS hk_order, "
          "CASE WHEN o_orderstatus = 'O' THEN 'true' WHEN o_orderstatus = 'F' THEN 'false' END AS is_open, "
          "o_orderpriority AS priority, md5(concat_ws('|', CASE WHEN o_orderstatus = 'O' THEN 't' WHEN o_orderstatus = 'F' THEN 'f' END, "
          "o_orderpriority)) AS dv_hashdiff, " + S.meta(T_RUN, "orders", "stage_s_order_flags") + " FROM orders")
def stage_sat_boolean(spark, d):
    """A boolean is ``true`` as an attribute and ``t`` inside the hashdiff, as the database prints them."""
    flag = F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False)
    orders = table(spark, d, "orders").withColumn("is_open", flag)
    return stage_sat(orders, S_ORDER_FLAGS, S_ORDER_FLAGS.sources[0], RUN)


# The version loaded last was applied first: by applied time the earlier load is the newest.
A_LATE, A_EARLY = "2023-06-01 00:00:00", "2023-01-01 00:00:00"


def _late_sql(sat: Sat, src: Source, load_sql) -> str:
    kw = {"strict": True, "present": _LINE_COLS}
    return (
        f"WITH sa AS ({sat_stage_sql(sat, src, 'lineitem', T_OLD, applied_ts=A_LATE, **kw)}), "
        f"v1 AS ({load_sql(sat, 'sa', None, T_OLD)}), "
        f"sb AS ({sat_stage_sql(sat, src, _B_LINES_FROM, T_MID, applied_ts=A_EARLY, **kw)}), "
        f"v2 AS ({load_sql(sat, 'sb', 'v1', T_MID)}), "
        "tgt AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2), "
        f"s AS ({sat_stage_sql(sat, src, _B_LINES_FROM, T_RUN, applied_ts=T_RUN, **kw)}) "
        + load_sql(sat, "s", "tgt", T_RUN)
    )


def _late(spark, d, sat: Sat, src: Source):
    r_old, r_mid, r_run = (Run(load_ts=t, applied_ts=a, semantics="strict")
                           for t, a in ((T_OLD, A_LATE), (T_MID, A_EARLY), (T_RUN, T_RUN)))
    li = table(spark, d, "lineitem")
    v1 = sat_delta(stage_sat(li, sat, src, r_old), None, sat, r_old)
    v2 = sat_delta(stage_sat(_b_lines(spark, d), sat, src, r_mid), v1, sat, r_mid)
    return sat_delta(stage_sat(_b_lines(spark, d), sat, src, r_run), v1.unionByName(v2), sat, r_run)


@register("load_sat_ckey_late_applied", _late_sql(S_LINE, _LINE_SRC, sat_ckey_load_sql))
def load_sat_ckey_late_applied(spark, d):
    """The correction was loaded later but applied earlier, so it isn't the latest and loads again."""
    return _late(spark, d, S_LINE, _LINE_SRC)


@register("load_sat_multiactive_late_applied", _late_sql(S_ORDER_PARTS, _MA_SRC, _ma_load_strict))
def load_sat_multiactive_late_applied(spark, d):
    """The same with sets: the newest by applied time is the first load."""
    return _late(spark, d, S_ORDER_PARTS, _MA_SRC)
