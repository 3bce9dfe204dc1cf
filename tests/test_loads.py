"""Golden tests: loaders on hand-written stages and targets (one per quirk)."""

from vaultsmith import Hub, Link, Run, Sat, Source, hub_delta, link_delta, sat_delta, stage_hub, stage_link, stage_sat
from vaultsmith.functions.windows import with_set_positions

T0, T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"


def run(ts, strict=False):
    return Run(load_ts=ts, semantics="strict" if strict else "reference")


HUB = Hub("h", "hk", "bk", [Source("src", bks=["k"])])


def _hub_stage(spark, keys, r):
    return stage_hub(spark.createDataFrame([(k,) for k in keys], "k string"), HUB, HUB.sources[0], r)


def test_hub_duplicates_of_new_key_all_loaded_in_reference(spark):
    st = _hub_stage(spark, ["a", "a", "b"], run(T1))
    tgt = hub_delta(_hub_stage(spark, ["b"], run(T0)), None, HUB, run(T0))
    assert sorted(r.bk for r in hub_delta(st, tgt, HUB, run(T1)).collect()) == ["a", "a"]
    st_strict = _hub_stage(spark, ["a", "a", "b"], run(T1, True))
    assert [r.bk for r in hub_delta(st_strict, tgt, HUB, run(T1, True)).collect()] == ["a"]


def test_hub_delta_meta(spark):
    r = hub_delta(_hub_stage(spark, ["a"], run(T1)), None, HUB, run(T2)).first()
    assert str(r.dv_loadts) == T2 and str(r.dv_appts) == T1 and r.dv_taskid == "load_h"


def test_hub_two_sources_first_wins(spark):
    hub = Hub("h", "hk", "bk", [Source("s1", bks=["k"]), Source("s2", bks=["k"])])
    r = run(T1)
    s1 = stage_hub(spark.createDataFrame([("a",), ("b",)], "k string"), hub, hub.sources[0], r)
    s2 = stage_hub(spark.createDataFrame([("b",), ("c",), ("c",), ("d",)], "k string"), hub, hub.sources[1], r)
    tgt = hub_delta(_hub_stage(spark, ["d"], run(T0)), None, HUB, run(T0))
    got = sorted((x.bk, x.dv_recsrc) for x in hub_delta([s1, s2], tgt, hub, r).collect())
    assert got == [("a", "s1"), ("b", "s1"), ("c", "s2"), ("c", "s2")]


LINK = Link("l", "lk", ["hk_a", "hk_b"], cks={"n": "n_ck"}, sources=[Source("src", bks={"a": "hk_a", "b": "hk_b"})])


def _link_stage(spark, rows, r):
    return stage_link(spark.createDataFrame(rows, "a string, b string, n int"), LINK, LINK.sources[0], r)


def test_link_new_child_key_on_known_link(spark):
    tgt = link_delta(_link_stage(spark, [("1", "2", 1)], run(T0)), None, LINK, run(T0))
    st = _link_stage(spark, [("1", "2", 1), ("1", "2", 2), ("3", "4", 1)], run(T1))
    ref = sorted((x.n_ck) for x in link_delta(st, tgt, LINK, run(T1)).collect())
    assert ref == ["1"]  # only the new link key (3,4); child key 2 of (1,2) is dropped
    st_s = _link_stage(spark, [("1", "2", 1), ("1", "2", 2), ("3", "4", 1)], run(T1, True))
    strict = link_delta(st_s, tgt, LINK, run(T1, True)).collect()
    assert len(strict) == 2


SAT = Sat("s", "hk", ["v"], sources=[Source("src", bks=["k"], attrs={"a": "v"})])


def _sat_stage(spark, rows, r, sat=SAT):
    return stage_sat(spark.createDataFrame(rows, "k string, a string"), sat, sat.sources[0], r)


def test_regular_sat_ignores_changes_of_known_keys(spark):
    tgt = sat_delta(_sat_stage(spark, [("1", "x")], run(T0)), None, SAT, run(T0))
    st = [("1", "y"), ("2", "z"), ("2", "z")]
    ref = sat_delta(_sat_stage(spark, st, run(T1)), tgt, SAT, run(T1)).collect()
    assert [(r.v) for r in ref] == ["z"]  # distinct, and the change of key 1 is not recorded
    strict = sat_delta(_sat_stage(spark, st, run(T1, True)), tgt, SAT, run(T1, True)).collect()
    assert sorted(r.v for r in strict) == ["y", "z"]


CK = Sat("sc", "hk", ["v"], cks={"c": "c_ck"}, sources=[Source("src", bks=["k"], attrs={"a": "v"})])


def _ck_stage(spark, rows, r, business=True):
    df = spark.createDataFrame(rows, "k string, c string, a string")
    return stage_sat(df, CK, CK.sources[0], r, business=business)


def test_child_key_history_a_b_a(spark):
    v1 = sat_delta(_ck_stage(spark, [("1", "c", "A")], run(T0)), None, CK, run(T0))
    v2 = sat_delta(_ck_stage(spark, [("1", "c", "B")], run(T1)), v1, CK, run(T1))
    assert v2.count() == 1
    tgt = v1.unionByName(v2)
    got = sat_delta(_ck_stage(spark, [("1", "c", "A")], run(T2)), tgt, CK, run(T2)).collect()
    assert [r.v for r in got] == ["A"]  # A differs from the latest version B
    again = sat_delta(_ck_stage(spark, [("1", "c", "B")], run(T2)), tgt, CK, run(T2))
    assert again.count() == 0


def test_child_key_ties_both_latest(spark):
    both = sat_delta(_ck_stage(spark, [("1", "c", "A"), ("1", "c", "B")], run(T0)), None, CK, run(T0))
    assert both.count() == 2
    for v in ("A", "B"):
        assert sat_delta(_ck_stage(spark, [("1", "c", v)], run(T1)), both, CK, run(T1)).count() == 0


def test_business_null_child_key_reloads_every_run(spark):
    v1 = sat_delta(_ck_stage(spark, [("1", None, "A"), ("2", "c", "A")], run(T0)), None, CK, run(T0))
    got = sat_delta(_ck_stage(spark, [("1", None, "A"), ("2", "c", "A")], run(T1)), v1, CK, run(T1)).collect()
    assert [(r.hk is not None, r.c_ck) for r in got] == [(True, None)]


def test_null_applied_time_counts_as_newest(spark):
    from pyspark.sql import functions as F

    old = sat_delta(_ck_stage(spark, [("1", "c", "A")], run(T0)), None, CK, run(T0))
    newer = sat_delta(_ck_stage(spark, [("1", "c", "B")], run(T1)), old, CK, run(T1))
    tgt = old.withColumn("dv_appts", F.lit(None).cast("timestamp_ntz")).unionByName(newer)
    # Latest is the NULL-time row A, so staging A adds nothing, B is added.
    assert sat_delta(_ck_stage(spark, [("1", "c", "A")], run(T2)), tgt, CK, run(T2)).count() == 0
    assert sat_delta(_ck_stage(spark, [("1", "c", "B")], run(T2)), tgt, CK, run(T2)).count() == 1


MA = Sat("sm", "hk", ["v"], multiactive=True, sources=[Source("src", bks=["k"], attrs={"a": "v"})])


def _ma(spark, rows, r):
    return _sat_stage(spark, rows, r, MA)


def _ma_target(spark):
    return sat_delta(_ma(spark, [("1", "x"), ("1", "y")], run(T0)), None, MA, run(T0))


def test_multiactive_first_load_numbers_sets(spark):
    got = _ma_target(spark).collect()
    # dv_subseq numbers the distinct hashdiffs of a key in hashdiff order.
    by_diff = sorted((r.dv_hashdiff, r.dv_subseq) for r in got)
    assert [s for _, s in by_diff] == [1, 2] and {r.v for r in got} == {"x", "y"}


def test_multiactive_same_set_adds_nothing(spark):
    st = _ma(spark, [("1", "y"), ("1", "x")], run(T1))
    assert sat_delta(st, _ma_target(spark), MA, run(T1)).count() == 0


def test_multiactive_grown_shrunk_changed(spark):
    tgt = _ma_target(spark)
    for rows, n in ([("1", "x"), ("1", "y"), ("1", "z")], 3), ([("1", "x")], 1), ([("1", "x"), ("1", "w")], 2):
        got = sat_delta(_ma(spark, rows, run(T1)), tgt, MA, run(T1)).collect()
        assert len(got) == n
        assert sorted(r.dv_subseq for r in got) == list(range(1, n + 1))
        assert all(str(r.dv_loadts) == T1 for r in got)  # staged load time kept


def test_multiactive_duplicates_kept_in_reference(spark):
    rows = [("1", "x"), ("1", "x"), ("1", "z")]
    ref = sat_delta(_ma(spark, rows, run(T1)), _ma_target(spark), MA, run(T1)).collect()
    assert sorted(r.v for r in ref) == ["x", "x", "z"]
    assert len({r.dv_subseq for r in ref if r.v == "x"}) == 1 and sorted({r.dv_subseq for r in ref}) == [1, 2]
    strict = sat_delta(_ma(spark, rows, run(T1, True)), _ma_target(spark), MA, run(T1, True)).collect()
    assert len(strict) == 2


def test_multiactive_keys_missing_from_stage_untouched(spark):
    st = _ma(spark, [("2", "q")], run(T1))
    got = sat_delta(st, _ma_target(spark), MA, run(T1)).collect()
    assert len(got) == 1 and got[0].v == "q"


def test_set_positions_equals_dense_rank_with_hot_key(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    pairs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("h"),
    ).distinct()
    counted = pairs.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    got = with_set_positions(counted, ["k"], "h", "n", in_range=10)
    w = Window.partitionBy("k").orderBy("h")
    want = pairs.select("k", "h", F.dense_rank().over(w).cast("int").alias("dv_subseq"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
