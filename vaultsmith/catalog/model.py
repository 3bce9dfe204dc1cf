"""The test vault model over the TPC-H-style tables, and the run settings the
checked queries use. Targets ("already loaded") are earlier loads of the
same tables, split by a date or an attribute; stages are whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..run import Run
from ..spec import Hub, Link, Sat, Source

# Run timestamps: an earlier load that built the target, and this run.
T_OLD = "2024-01-01 00:00:00"
T_MID = "2024-03-01 00:00:00"
T_RUN = "2024-06-01 00:00:00"

RUN_OLD = Run(load_ts=T_OLD)
RUN = Run(load_ts=T_RUN)
RUN_STRICT = Run(load_ts=T_RUN, semantics="strict")
RUN_OLD_STRICT = Run(load_ts=T_OLD, semantics="strict")

# Date splits of the fact tables ("loaded before" / "this run").
SHIP_SPLIT = "1999-01-01"
ORDER_SPLIT = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ hubs
SRC_CUSTOMER = Source("customer", bks=["c_custkey"])
SRC_ORDERS_CUST = Source("orders", bks=["o_custkey"])
H_CUSTOMER = Hub("h_customer", hk="hk_customer", bk="customer_bk", sources=[SRC_CUSTOMER])
H_CUSTOMER_2SRC = Hub("h_customer", hk="hk_customer", bk="customer_bk", sources=[SRC_CUSTOMER, SRC_ORDERS_CUST])
H_ORDER = Hub("h_order", hk="hk_order", bk="order_bk", sources=[Source("orders", bks=["o_orderkey"])])
H_PART = Hub("h_part", hk="hk_part", bk="part_bk", sources=[Source("part", bks=["p_partkey"])])
H_SUPPLIER = Hub("h_supplier", hk="hk_supplier", bk="supplier_bk", sources=[Source("supplier", bks=["s_suppkey"])])
H_LINE = Hub(
    "h_line", hk="hk_line", bk="line_bk",
    sources=[Source("lineitem", bks=["l_orderkey", "l_linenumber"], tenant="tpch", bkeycode="line")],
)

# ------------------------------------------------------------------ links
SRC_LINEITEM_LINK = Source("lineitem", bks={"l_orderkey": "hk_order", "l_partkey": "hk_part", "l_suppkey": "hk_supplier"})
L_LINEITEM = Link(
    "l_lineitem", hk="hk_lineitem", hks=["hk_order", "hk_part", "hk_supplier"],
    cks={"l_linenumber": "linenumber_ck"}, sources=[SRC_LINEITEM_LINK],
)
# Order-supplier link: several line numbers share a link key.
L_ORDER_SUPPLIER = Link(
    "l_order_supplier", hk="hk_order_supplier", hks=["hk_order", "hk_supplier"],
    cks={"l_linenumber": "linenumber_ck"},
    sources=[Source("lineitem", bks={"l_orderkey": "hk_order", "l_suppkey": "hk_supplier"})],
)
# Link whose model names a column the source lacks (and a hub key with no mapping).
L_MISSING = Link(
    "l_line_ship", hk="hk_line_ship", hks=["hk_order", "hk_shipper", "hk_part"],
    cks={"l_linenumber": "linenumber_ck", "l_shipmode": "shipmode_ck"},
    sources=[Source("lineitem", bks={"l_orderkey": "hk_order", "l_shipperkey": "hk_shipper"})],
)
# Composite hub key inside a link: two columns feed one hub key.
L_COMPOSITE = Link(
    "l_line_part", hk="hk_line_part", hks=["hk_line", "hk_part"],
    sources=[Source("lineitem", bks={"l_orderkey": "hk_line", "l_linenumber": "hk_line", "l_partkey": "hk_part"},
                    tenant="tpch", bkeycode="line")],
)

# ------------------------------------------------------------- satellites
S_CUSTOMER = Sat(
    "s_customer", hk="hk_customer", attrs=["name", "balance", "segment"],
    sources=[Source("customer", bks=["c_custkey"], attrs={"c_name": "name", "c_acctbal": "balance",
                                                          "c_mktsegment": "segment"})],
)
S_ORDER = Sat(
    "s_order", hk="hk_order", attrs=["status", "totalprice", "orderdate", "priority"],
    sources=[Source("orders", bks=["o_orderkey"], attrs={
        "o_orderstatus": "status", "o_totalprice": "totalprice", "o_orderdate": "orderdate",
        "o_orderpriority": "priority"})],
)
# Map order differs from the attribute order: positional insert swaps values.
S_ORDER_SWAPPED = Sat(
    "s_order_swapped", hk="hk_order", attrs=["status", "priority"],
    sources=[Source("orders", bks=["o_orderkey"], attrs={"o_orderpriority": "priority", "o_orderstatus": "status"})],
)
S_LINE = Sat(
    "s_lineitem", hk="hk_order", attrs=["quantity", "price", "shipdate"], cks={"l_linenumber": "linenumber_ck"},
    sources=[Source("lineitem", bks=["l_orderkey"], attrs={
        "l_quantity": "quantity", "l_extendedprice": "price", "l_shipdate": "shipdate"})],
)
S_ORDER_PARTS = Sat(
    "s_order_parts", hk="hk_order", attrs=["partkey", "quantity"], multiactive=True,
    sources=[Source("lineitem", bks=["l_orderkey"], attrs={"l_partkey": "partkey", "l_quantity": "quantity"})],
)


# ------------------------------------------------------ whole-vault model
TPCH_MODEL_YAML = """
connection:
  schemas: {source: tpch, stage: tpch_stage, edwh: tpch_vault}
rv:
  hubs:
    h_customer: {hk: hk_customer, bk: customer_bk,
                 src: {customer: {bks: [c_custkey]}, orders: {bks: [o_custkey]}}}
    h_order:    {hk: hk_order, bk: order_bk, src: {orders: {bks: [o_orderkey]}}}
    h_part:     {hk: hk_part, bk: part_bk, src: {part: {bks: [p_partkey]}}}
    h_supplier: {hk: hk_supplier, bk: supplier_bk, src: {supplier: {bks: [s_suppkey]}}}
  links:
    l_order_customer:
      hk: hk_order_customer
      hks: [hk_order, hk_customer]
      src: {orders: {bks: {o_orderkey: hk_order, o_custkey: hk_customer}}}
    l_lineitem:
      hk: hk_lineitem
      hks: [hk_order, hk_part, hk_supplier]
      cks: {l_linenumber: linenumber_ck}
      src: {lineitem: {bks: {l_orderkey: hk_order, l_partkey: hk_part, l_suppkey: hk_supplier}}}
    l_part_supplier:
      hk: hk_part_supplier
      hks: [hk_part, hk_supplier]
      src: {lineitem: {bks: {l_partkey: hk_part, l_suppkey: hk_supplier}}}
  sats:
    s_customer:
      hk: hk_customer
      attrs: [name, balance, segment]
      src: {customer: {bks: [c_custkey], attrs: {c_name: name, c_acctbal: balance, c_mktsegment: segment}}}
    s_order:
      hk: hk_order
      attrs: [status, totalprice, orderdate, priority]
      src: {orders: {bks: [o_orderkey], attrs: {o_orderstatus: status, o_totalprice: totalprice,
                                               o_orderdate: orderdate, o_orderpriority: priority}}}
    s_lineitem:
      hk: hk_order
      cks: {l_linenumber: linenumber_ck}
      attrs: [quantity, price, shipdate]
      src: {lineitem: {bks: [l_orderkey], attrs: {l_quantity: quantity, l_extendedprice: price,
                                                 l_shipdate: shipdate}}}
    s_order_parts:
      hk: hk_order
      multiactive: true
      attrs: [partkey, quantity]
      src: {lineitem: {bks: [l_orderkey], attrs: {l_partkey: partkey, l_quantity: quantity}}}
  effs:
    es_part_supplier: {link: l_part_supplier, drivers: [hk_part]}
bv:
  hubs:
    bv_h_segment_nation:
      hk: hk_segment_nation
      bk: segment_nation_bk
      src:
        segment_nation_sql:
          bks: [n_name, c_mktsegment]
          sql: "SELECT c.c_mktsegment, n.n_name FROM tpch.customer c JOIN tpch.nation n ON c.c_nationkey = n.n_nationkey"
  sats:
    bv_s_order_customer:
      hk: hk_order
      attrs: [customer_name, nation]
      dependencies: [load__bv_h_segment_nation]
      src:
        order_customer_sql:
          bks: [o_orderkey]
          attrs: {c_name: customer_name, n_name: nation}
          sql: >-
            SELECT o.o_orderkey, c.c_name, n.n_name FROM tpch.orders o
            JOIN tpch.customer c ON o.o_custkey = c.c_custkey
            JOIN tpch.nation n ON c.c_nationkey = n.n_nationkey
"""
