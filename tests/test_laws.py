"""Laws that hold for every load, checked on the small test tables."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultsmith import Run, hub_delta, link_delta, sat_delta, stage_hub, stage_link, stage_sat
from vaultsmith.catalog.effectivity_queries import effectivity_open_close
from vaultsmith.catalog.model import (
    H_CUSTOMER, H_ORDER, H_PART, H_SUPPLIER, L_LINEITEM, S_CUSTOMER, S_LINE, S_ORDER_PARTS, table,
)
from vaultsmith.functions.windows import with_set_positions

from .conftest import SF_SMALL

T0, T1 = Run(load_ts="2024-01-01 00:00:00"), Run(load_ts="2024-02-01 00:00:00")


def _loaded(spark, entity, delta_fn, name):
    src = table(spark, SF_SMALL, name)
    first = delta_fn(stage(src, entity, T0), None, entity, T0)
    return src, first


def stage(df, entity, run):
    if entity.kind == "hub":
        return stage_hub(df, entity, entity.sources[0], run)
    if entity.kind == "link":
        return stage_link(df, entity, entity.sources[0], run)
    return stage_sat(df, entity, entity.sources[0], run)


@pytest.mark.parametrize("entity,fn,src", [
    (H_CUSTOMER, hub_delta, "customer"),
    (L_LINEITEM, link_delta, "lineitem"),
    (S_CUSTOMER, sat_delta, "customer"),
    (S_LINE, sat_delta, "lineitem"),
    (S_ORDER_PARTS, sat_delta, "lineitem"),
])
def test_loading_the_same_stage_twice_adds_nothing(spark, entity, fn, src):
    df, first = _loaded(spark, entity, fn, src)
    assert first.count() > 0
    assert fn(stage(df, entity, T1), first, entity, T1).count() == 0


def test_delta_keys_are_disjoint_from_target(spark):
    cust = table(spark, SF_SMALL, "customer")
    target = hub_delta(stage(cust.where("c_nationkey < 10"), H_CUSTOMER, T0), None, H_CUSTOMER, T0)
    delta = hub_delta(stage(cust, H_CUSTOMER, T1), target, H_CUSTOMER, T1)
    assert delta.join(target, "hk_customer").count() == 0
    assert delta.count() + target.count() == cust.count()


def test_multiactive_loads_all_or_none_of_a_key(spark):
    li = table(spark, SF_SMALL, "lineitem")
    old = sat_delta(stage(li.where("l_shipdate < TIMESTAMP_NTZ '1999-01-01'"), S_ORDER_PARTS, T0), None,
                    S_ORDER_PARTS, T0)
    st_rows = stage(li, S_ORDER_PARTS, T1)
    delta = sat_delta(st_rows, old, S_ORDER_PARTS, T1)
    per_key_delta = delta.groupBy("hk_order").count().withColumnRenamed("count", "n_delta")
    per_key_stage = st_rows.groupBy("hk_order").count().withColumnRenamed("count", "n_stage")
    joined = per_key_delta.join(per_key_stage, "hk_order")
    assert joined.where("n_delta != n_stage").count() == 0
    assert delta.count() > 0


def test_link_hub_keys_join_to_hub_keys(spark):
    li = table(spark, SF_SMALL, "lineitem")
    link = stage(li, L_LINEITEM, T0)
    for hub, col, src in ((H_ORDER, "hk_order", "orders"), (H_PART, "hk_part", "part"),
                          (H_SUPPLIER, "hk_supplier", "supplier")):
        hubs = stage(table(spark, SF_SMALL, src), hub, T0)
        assert link.join(hubs, col, "left_anti").count() == 0


def test_effectivity_opens_and_closes(spark):
    df = effectivity_open_close(spark, SF_SMALL)
    rows = df.groupBy(F.col("dv_endts") == F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).count().collect()
    kinds = {r[0]: r[1] for r in rows}
    assert kinds.get(True, 0) > 0 and kinds.get(False, 0) > 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(0, 400)), min_size=1, max_size=60))
def test_bucketed_dense_rank_equals_dense_rank(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v int").select(
        "k", F.md5(F.col("v").cast("string")).alias("h")).distinct()
    counted = df.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    got = with_set_positions(counted, ["k"], "h", "n", in_range=3)
    want = df.select("k", "h", F.dense_rank().over(Window.partitionBy("k").orderBy("h")).cast("int").alias("dv_subseq"))
    assert sorted(got.collect()) == sorted(want.collect())
