"""Heavy keys are spread over tasks, and targets are cut down to the staged keys."""

import contextlib

import pytest
from pyspark.sql import functions as F

from vaultsmith import Run, Source
from vaultsmith.catalog import registry
from vaultsmith.functions import prune
from vaultsmith.functions.heavy import heavy_hashes, join_one_per_key
from vaultsmith.functions.windows import with_set_positions
from vaultsmith.operators.load import hub_delta, sat_delta
from vaultsmith.plans.explain import plan_text
from vaultsmith.spec import Hub

HOT = 200_000


@contextlib.contextmanager
def plain_shuffles(spark, **more):
    """No coalescing and no broadcast: rows by partition are rows by task."""
    kv = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", **more}
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark):
    """Two of three rows share one key."""
    key = F.when(F.col("id") < HOT, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(HOT * 3 // 2).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("h"))


def task_rows(df):
    """Rows by partition of ``df``'s last stage, largest first, and their median."""
    counts = sorted((r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()),
                    reverse=True)
    return counts[0], counts[len(counts) // 2]


def test_a_heavy_key_is_found_and_spread(spark):
    rows = hot_rows(spark)
    assert rows.select(F.size(heavy_hashes(rows, ["k"])).alias("n")).first()["n"] == 1
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    with plain_shuffles(spark):
        joined = join_one_per_key(rows, per_key, ["k"], "h", rows)
        largest, median = task_rows(joined)
        assert largest <= 3 * median
        assert joined.count() == rows.count() and joined.where("k = 'hot'").select("n").distinct().first()["n"] == HOT


def test_null_keys_and_empty_tables_join_nothing(spark):
    rows = spark.sql("SELECT * FROM VALUES (CAST(NULL AS STRING), 'a'), ('k', 'b') AS t(k, h)")
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert [r["k"] for r in join_one_per_key(rows, per_key, ["k"], "h", rows).collect()] == ["k"]
    assert join_one_per_key(rows.where("false"), per_key, ["k"], "h", rows.where("false")).count() == 0


def test_one_key_with_many_values_is_ranked_in_ranges(spark):
    rows = hot_rows(spark).withColumn("n", F.when(F.col("k") == "hot", HOT).otherwise(20))
    with plain_shuffles(spark):
        placed = with_set_positions(rows, ["k"], "h", "n")
        largest, median = task_rows(placed)
        assert largest <= 3 * median
        got = placed.where("k = 'hot'").orderBy("h").select("dv_subseq").collect()
    assert [r["dv_subseq"] for r in got] == list(range(1, HOT + 1))


@pytest.mark.parametrize("name", ["load_sat_ckey_hot_key", "load_sat_multiactive_hot_key"])
def test_hot_key_queries_spread_their_rows(spark, name):
    """A third of the staged rows share the zero-key hash."""
    with plain_shuffles(spark):
        largest, median = task_rows(registry.queries()[name](spark, "/root/testdata/sf0.01"))
    assert largest <= 3 * median


# ------------------------------------------------------------- pruning
def stored(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_a_target_is_cut_down_to_the_staged_keys(spark, tmp_path):
    target = stored(spark, tmp_path, "t", spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("hk")).union(
        spark.sql("SELECT CAST(NULL AS STRING)")))
    staged = spark.range(99_000, 101_000).select(F.md5(F.col("id").cast("string")).alias("hk"))
    kept = prune.pruned(target, [staged], "hk", prune_from=0)
    assert kept.join(staged, "hk", "left_semi").count() == 1000
    share = prune.WORDS * 64
    assert kept.count() <= 1000 + 3 * 100_000 * 2000 / share + 20  # staged keys, and the share of set bits
    # Over half full: no pruning. Small tables and derived frames: none either.
    assert prune.pruned(target, [staged], "hk", words=8, prune_from=0).count() == 100_000
    assert prune.pruned(target, [staged], "hk") is target
    derived = target.groupBy("hk").count()
    assert prune.pruned(derived, [staged], "hk", prune_from=0) is derived


@pytest.mark.parametrize("multi", [False, True])
def test_pruned_loads_equal_plain_ones(spark, tmp_path, monkeypatch, multi):
    from .test_many_sources import CKEY, MULTI, RUN, frames, scenarios

    target, stages = scenarios(2, seed=20 + multi, keys=120)
    tgt, st = frames(spark, target, stages, multi)
    if multi:
        tgt, st = tgt.drop("ck"), [s.drop("ck") for s in st]
    tgt = stored(spark, tmp_path, "t", tgt)
    rows = lambda: sorted(map(str, sat_delta(st, tgt, MULTI if multi else CKEY, RUN).collect()))
    plain = rows()
    monkeypatch.setattr(prune, "PRUNE_FROM", 0)
    assert rows() == plain and len(plain) > 0


def test_hub_loads_prune_and_keep_their_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prune, "PRUNE_FROM", 0)
    hub = Hub("h", "hk", "bk", [Source("x", bks=["id"])])
    run = Run(load_ts="2024-01-01 00:00:00")
    meta = [F.lit(None).cast("timestamp_ntz").alias("dv_appts"), *[F.lit("x").alias(c) for c in ("dv_recsrc", "dv_tenant", "dv_bkeycode")]]
    key = F.md5(F.col("id").cast("string")).alias("hk")
    target = stored(spark, tmp_path, "t", spark.range(0, 50_000).select(key, F.col("id").cast("string").alias("bk")))
    staged = spark.range(49_990, 50_010).select(key, F.col("id").cast("string").alias("bk"), *meta)
    delta = hub_delta(staged, target.select("hk"), hub, run)
    assert "bit_or" in plan_text(delta, "simple")
    assert sorted(r["bk"] for r in delta.collect()) == [str(k) for k in range(50_000, 50_010)]
