"""Plan shape at scale: hot keys are split, no cross products, pruned scans."""

import contextlib

import pytest

from vaultsmith.catalog import registry
from vaultsmith.catalog.hot_key_queries import load_sat_regular_hot_key
from vaultsmith.plans.explain import plan_summary, plan_text

from .conftest import SF_SMALL

SF_MID = "/root/testdata/sf0.01"


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_anti_join_is_split_by_aqe(spark):
    """A third of the staged rows share the zero-key hash; with a shuffled
    join AQE splits that partition over several tasks (the distinct runs
    before the join, so nothing after it needs the key partitioning)."""
    with conf(spark, **{
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }):
        df = load_sat_regular_hot_key(spark, SF_MID)
        rows = df.collect()
        final = plan_text(df, "simple")
    assert len(rows) > 0
    assert "isFinalPlan=true" in final
    assert "skew=true" in final


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_products_or_python(spark, name):
    summary = plan_summary(registry.queries()[name](spark, SF_SMALL))
    assert summary["forbidden"] == []


def test_scans_are_pruned(spark):
    """A hub load reads only the key column of the customer source."""
    df = registry.queries()["load_hub_incremental"](spark, SF_SMALL)
    schemas = plan_summary(df)["read_schemas"]
    assert schemas and all(s.startswith("struct<c_custkey:bigint") for s in schemas)
    assert all("c_name" not in s for s in schemas[:1])


def test_date_filters_reach_the_scan(spark):
    text = plan_text(registry.queries()["load_link_incremental"](spark, SF_SMALL), "formatted")
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate," in text


def test_bucketed_target_is_not_reshuffled(spark):
    """With the vault table bucketed by hash key, the anti join reads the
    target already partitioned: only the staged side is exchanged."""
    from vaultsmith import Hub, Run, Source, hub_delta, stage_hub
    from vaultsmith.sinks.tables import append, ensure_schema, ensure_table, table_columns
    from vaultsmith.sources.tables import vault_table

    hub = Hub("h_bucketed", "hk_customer", "customer_bk", [Source("customer", bks=["c_custkey"])])
    ensure_schema(spark, "bucket_vault")
    name = "bucket_vault.h_bucketed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, table_columns(hub), hub.hk, 8)
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    run0, run1 = Run(load_ts="2024-01-01 00:00:00"), Run(load_ts="2024-02-01 00:00:00")
    append(hub_delta(stage_hub(cust.where("c_nationkey < 10"), hub, hub.sources[0], run0), None, hub, run0), name)
    with conf(spark, **{"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        delta = hub_delta(stage_hub(cust, hub, hub.sources[0], run1), vault_table(spark, name, [hub.hk]), hub, run1)
        text = plan_text(delta, "formatted")
        assert "Bucketed: true" in text
        assert plan_summary(delta)["exchanges"] == 1  # the staged side only
        assert delta.count() == cust.count() - cust.where("c_nationkey < 10").count()
    spark.sql("DROP DATABASE bucket_vault CASCADE")
