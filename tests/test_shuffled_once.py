"""Rows are shuffled once, with their digests packed, and written without another shuffle."""

from pyspark.sql import functions as F

from vaultsmith import Run
from vaultsmith.functions.heavy import split
from vaultsmith.functions.keys import pack, unpack
from vaultsmith.operators.load import _new_rows, _placed_sets, _tagged, hub_delta, link_delta, sat_delta
from vaultsmith.plans.explain import plan_summary, plan_text
from vaultsmith.sinks.tables import _rebalanced, ensure_table, table_columns

from .test_many_sources import CKEY, MULTI, RUN, frames, scenarios


def test_packed_texts_come_back_and_keep_apart(spark):
    digest = "00ff" * 8
    texts = [None, "", "a", "0a", "0A", digest, digest.upper(), digest[:-1] + "g", digest + "\n", digest + "00", "x" * 16, "é", "-1"]
    rows = spark.createDataFrame([(t,) for t in texts], "k string")
    packed = pack(rows, ["k"])
    assert [r["k"] for r in unpack(packed, ["k"]).collect()] == texts
    assert packed.distinct().count() == len(texts)
    digests = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert pack(digests, ["k"]).where(F.length("k") != 16).count() == 0
    ordered = [r["k"] for r in unpack(pack(digests, ["k"]).orderBy("k"), ["k"]).collect()]
    assert ordered == sorted(ordered)


def test_packing_takes_the_bytes_once(spark):
    """A digest is told by its letters, not by writing its bytes out again."""
    plan = plan_text(pack(spark.range(3).select(F.col("id").cast("string").alias("k")), ["k"]), "simple")
    assert plan.count("unhex(") == 1 and " hex(" not in plan and "(hex(" not in plan
    mixed = spark.createDataFrame([("0" * 31 + "G",), ("0" * 31 + "A",), ("é" * 32,), ("é" * 16,), ("0" * 30 + "é",), (" " * 32,)], "k string")
    assert unpack(pack(mixed, ["k"]), ["k"]).collect() == mixed.collect() and pack(mixed, ["k"]).where("length(k) = 16").count() == 0


def test_filters_do_not_copy_digests_into_the_scan(spark):
    """What a load computes from its rows is computed once, however many loads it comes from."""
    rows = spark.range(10).select(F.md5(F.col("id").cast("string")).alias("k"))
    for _ in range(3):
        rows = unpack(pack(rows, ["k"]).distinct().where("k IS NOT NULL"), ["k"]).where("k IS NOT NULL")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    assert rows.count() == 10


def test_strict_link_loads_shuffle_packed_digests(spark):
    from vaultsmith import Source
    from vaultsmith.spec import Link

    link = Link("l", hk="hk", hks=["a_hk", "b_hk"], cks={"c": "ck"}, sources=[Source("x", bks={"a": "a_hk", "b": "b_hk"})])
    strict = Run(load_ts="2024-06-01 00:00:00", semantics="strict")
    names = ["hk", "a_hk", "b_hk", "ck", "dv_recsrc", "dv_tenant", "dv_bkeycode"]
    known, short = "00ff" * 8, "a"

    def rows(keys):
        return spark.createDataFrame([(h, "0a" * 16, None, c, "r", "t", "c") for h, c in keys], ", ".join(f"{n} string" for n in names)
                                     ).withColumn("dv_appts", F.lit(None).cast("timestamp_ntz"))

    staged = rows([(known, "1"), (known, "2"), (known, "2"), (short, "1"), (short, None), (None, "1"), (None, "1")])
    target = rows([(known, "1"), (known, "1"), (short, "1"), (short, None), (None, "1")])
    delta = link_delta(staged, target, link, strict)
    plan = plan_text(delta, "simple")
    assert plan.index("lower(hex(") < plan.index("Join") < plan.rindex("unhex(")  # read back above the join, packed beneath
    # A NULL never matches.
    assert sorted((str(r["hk"]), r["a_hk"], r["b_hk"], str(r["ck"])) for r in delta.collect()) == sorted(
        [(known, "0a" * 16, None, "2"), (short, "0a" * 16, None, "None"), ("None", "0a" * 16, None, "1")])


def test_rows_of_plain_keys_are_shuffled_once(spark):
    target, stages = scenarios(2, seed=5, keys=40)
    tgt, st = frames(spark, target, stages, False)
    keys = [CKEY.hk, *CKEY.cks.values()]
    rows = _new_rows(_tagged(st), tgt, keys, [*keys, *CKEY.attrs, "dv_hashdiff"], len(st), RUN)
    assert plan_summary(rows)["exchanges"] == 1
    tgt, st = frames(spark, target, stages, True)
    tagged = _tagged([s.drop("ck") for s in st])
    # The rows, and the columns that are compared.
    assert plan_summary(_placed_sets(tagged, tgt.drop("ck"), MULTI.hk, len(st), RUN))["exchanges"] == 2
    assert plan_summary(_placed_sets(tagged, None, MULTI.hk, 1, RUN))["exchanges"] == 1


def test_heavy_and_plain_keys_load_the_same_rows(spark, monkeypatch):
    """All keys by one way, or all by the other."""
    from vaultsmith.operators import load

    for multi in (False, True):
        for n in (1, 3):
            target, stages = scenarios(n, seed=31 + n, keys=60)
            tgt, st = frames(spark, target, stages, multi)
            if multi:
                tgt, st = tgt.drop("ck"), [s.drop("ck") for s in st]
            got = []
            for heavy in (True, False):
                monkeypatch.setattr(load, "is_heavy", lambda *_, heavy=heavy: F.lit(heavy))
                got.append(sorted(map(str, sat_delta(st, tgt, MULTI if multi else CKEY, RUN).collect())))
            assert got[0] == got[1] and got[0]


def test_the_two_ways_share_a_derived_table(spark):
    """The heavy flag is not pushed beneath the distinct rows it is asked of."""
    rows = spark.range(1000).select((F.col("id") % 10).alias("k")).distinct()
    for part in split(rows, F.col("k") < 3):
        text = plan_text(part, "simple")
        assert text.index("Filter") < text.index("HashAggregate")
    assert [p.count() for p in split(rows, F.col("k") < 3)] == [7, 3]


def test_a_hot_target_key_reaches_the_join_once(spark):
    from vaultsmith import Source
    from vaultsmith.spec import Hub

    hub = Hub("h", "hk", "bk", [Source("x", bks=["id"])])
    meta = [F.lit(None).cast("timestamp_ntz").alias("dv_appts"), *[F.lit("x").alias(c) for c in ("dv_recsrc", "dv_tenant", "dv_bkeycode")]]
    staged = spark.range(5).select(F.col("id").cast("string").alias("hk"), F.lit("b").alias("bk"), *meta)
    target = spark.range(1000).select(F.lit("3").alias("hk"))
    delta = hub_delta(staged, target, hub, RUN)
    assert "HashAggregate" in plan_text(delta, "simple")
    assert sorted(r["hk"] for r in delta.collect()) == ["0", "1", "2", "4"]


def test_a_table_without_buckets_is_written_as_loaded(spark, scratch_db):
    from vaultsmith import Source
    from vaultsmith.spec import Hub

    hub = Hub("h", "hk", "bk", [Source("x", bks=["id"])])
    ensure_table(spark, f"{scratch_db}.h", table_columns(hub))
    rows = spark.createDataFrame([], spark.table(f"{scratch_db}.h").schema)
    assert plan_summary(_rebalanced(rows, f"{scratch_db}.h"))["exchanges"] == 0
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {scratch_db}.h").collect()}
    assert "zstd" in info["Storage Properties"]
