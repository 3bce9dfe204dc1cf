"""Golden tests: effectivity satellite over hand-written relations."""

from vaultsmith import Link, Run, Source, link_delta, stage_link
from vaultsmith.functions.keys import HIGH_DATE
from vaultsmith.operators.effectivity import effectivity_delta
from vaultsmith.spec import Effectivity

LINK = Link("l_ab", "hk_ab", ["hk_a", "hk_b"], sources=[Source("src", bks={"a": "hk_a", "b": "hk_b"})])
EFF = Effectivity("es_ab", link="l_ab", drivers=["hk_a"])
T1, T2, T3 = (Run(load_ts=f"2024-0{m}-01 00:00:00") for m in (1, 2, 3))


def _stage(spark, pairs, run):
    return stage_link(spark.createDataFrame(pairs, "a string, b string"), LINK, LINK.sources[0], run)


def _key(spark, a, b):
    return _stage(spark, [(a, b)], T1).first().hk_ab


def test_new_kept_moved_and_vanished(spark):
    s1 = _stage(spark, [("a1", "b1"), ("a2", "b2"), ("a3", "b3")], T1)
    link = link_delta(s1, None, LINK, T1)
    eff = effectivity_delta(s1, None, None, EFF, LINK, T1)
    assert eff.count() == 3 and all(str(r.dv_endts) == HIGH_DATE for r in eff.collect())

    # a1-b1 kept; a2 moved from b2 to b9; a3 vanished; a4-b4 new.
    s2 = _stage(spark, [("a1", "b1"), ("a2", "b9"), ("a4", "b4")], T2)
    link = link.unionByName(link_delta(s2, link, LINK, T2))
    d2 = effectivity_delta(s2, eff, link, EFF, LINK, T2)
    opened = [r for r in d2.collect() if str(r.dv_endts) == HIGH_DATE]
    closed = [r for r in d2.collect() if str(r.dv_endts) != HIGH_DATE]
    s2_keys = {r.hk_ab for r in s2.collect()}
    assert len(opened) == 2 and {r.hk_ab for r in opened} == s2_keys - {_key(spark, "a1", "b1")}
    assert all(str(r.dv_startts) == "2024-02-01 00:00:00" for r in opened)
    assert len(closed) == 1
    # The closed record is a2-b2: start kept, end = this run's applied time.
    assert closed[0].hk_ab == _key(spark, "a2", "b2")
    assert str(closed[0].dv_startts) == "2024-01-01 00:00:00" and str(closed[0].dv_endts) == "2024-02-01 00:00:00"
    # a3-b3 (driver vanished) stays open: nothing is written for it.
    assert len(d2.collect()) == 3

    # Rerunning the same snapshot adds nothing.
    eff2 = eff.unionByName(d2)
    d3 = effectivity_delta(_stage(spark, [("a1", "b1"), ("a2", "b9"), ("a4", "b4")], T3), eff2, link, EFF, LINK, T3)
    assert d3.count() == 0


def _odd(spark):
    """Two drivers under one link key, repeated and older records, NULL keys and times."""
    meta = "dv_recsrc string, dv_tenant string, dv_bkeycode string"
    k1, k2, k3, k4, a, b, c = ("%032x" % n for n in range(1, 8))
    staged = spark.createDataFrame(
        [(k1, a, "r", "t", "c"), (k1, a, "r", "t", "c"), (k2, b, "r", "t", "c"), (k2, c, "r", "t", "c"), (None, a, "r", "t", "c"),
         ("short", a, "r", None, "c")], "hk_ab string, hk_a string, " + meta)
    link = spark.createDataFrame([(k1, a), (k3, a), (k3, a), (k3, "gone"), (k4, b), (k4, c), (None, a)], "hk_ab string, hk_a string")
    high, old = HIGH_DATE, "2024-01-01 00:00:00"
    records = [(k1, old, high, old), (k2, old, high, old),  # open, but k2 is in no link row
               (k3, old, high, old), (k3, old, high, old), (k4, old, high, old), (k4, old, old, None), (None, old, high, old)]
    target = spark.createDataFrame([(*r, "r", "t", None) for r in records], "hk_ab string, s string, e string, l string, " + meta)
    stamp = lambda n, to: target[n].cast("timestamp_ntz").alias(to)
    target = target.select("hk_ab", stamp("s", "dv_startts"), stamp("e", "dv_endts"), stamp("l", "dv_loadts"), stamp("l", "dv_appts"),
                           "dv_recsrc", "dv_tenant", "dv_bkeycode")
    return staged, target, link, (k1, k2, k3, k4)


def test_odd_rows_open_and_close(spark):
    staged, target, link, (_, k2, k3, _) = _odd(spark)
    got = effectivity_delta(staged, target, link, EFF, LINK, T2).collect()
    rows = sorted((str(r.hk_ab), str(r.dv_startts)[:10], str(r.dv_endts)[:10], str(r.dv_tenant), str(r.dv_bkeycode)) for r in got)
    new = ("2024-02-01", "9999-12-31")
    # k4's newest record (NULL times) is closed already; k3 is closed once, its other driver has gone.
    assert rows == sorted([(k2, *new, "t", "c"), (k2, *new, "t", "c"), ("None", *new, "t", "c"), ("short", *new, "None", "c"),
                           (k3, "2024-01-01", "2024-02-01", "t", "None")])


def test_relations_are_shuffled_packed_and_few_times(spark):
    from vaultsmith.plans.explain import plan_summary, plan_text

    staged, target, link, _ = _odd(spark)
    delta = effectivity_delta(staged, target, link, EFF, LINK, T2)
    # Distinct relations, link rows and drivers, each side of the join on the key, and the join on the driver.
    assert plan_summary(delta)["exchanges"] <= 7
    assert "unhex(" in plan_text(delta, "simple")
