"""Several sources in one plan against the same sources loaded one after another in plain Python."""

import hashlib
import random
import re

import pytest

from vaultsmith import Run, Sat, Source
from vaultsmith.catalog.many_source_queries import load_sat_ckey_five_sources
from vaultsmith.functions import prune
from vaultsmith.operators import load
from vaultsmith.operators.load import sat_delta
from vaultsmith.plans.explain import plan_text

from .conftest import SF_SMALL

T = ["2024-01-01 00:00:00", "2024-06-01 00:00:00", "2025-01-01 00:00:00"]
RUN = Run(load_ts=T[1])
SRC = Source("x", bks=["id"], attrs={"v": "v"})
CKEY = Sat("s", hk="hk", attrs=["v"], cks={"c": "ck"}, sources=[SRC])
MULTI = Sat("s", hk="hk", attrs=["v"], multiactive=True, sources=[SRC])
META = "dv_loadts timestamp_ntz, dv_appts timestamp_ntz, dv_recsrc string, dv_tenant string, dv_bkeycode string"
STAGED = f"hk string, ck string, v string, dv_hashdiff string, {META}"


def digest(v):
    return hashlib.md5(v.encode()).hexdigest()


def scenarios(n_sources, seed, keys=250):
    """Random targets and stages: one scenario per key."""
    rng = random.Random(seed)
    target, stages = [], [[] for _ in range(n_sources)]
    for k in range(keys):
        values = [f"v{k}_{i}" for i in range(rng.choice([1, 2, 3, 5]))]
        ck = rng.choice(["a", "a", "a", None])
        for t in rng.sample([*T, None], rng.choice([0, 1, 1, 2])):
            for v in rng.sample(values, rng.randint(1, len(values))):
                target.append((f"k{k}", ck, v, t))
        for s in stages:
            if rng.random() < 0.8:
                picked = rng.sample(values, rng.randint(1, len(values)))
                s += [(f"k{k}", ck, v) for v in picked + picked[:rng.choice([0, 0, 1])]]
    return target, stages


def age(t):
    return (1, "") if t is None else (0, t)


def one_by_one_ckey(target, stages):
    held, out = list(target), []
    for s in stages:
        current = {}
        for hk, ck, v, t in held:
            if ck is not None:
                current.setdefault((hk, ck), []).append((age(t), v))
        latest = {key: {v for a, v in rows if a == max(rows)[0]} for key, rows in current.items()}
        new = sorted({r for r in s if r[2] not in latest.get(r[:2], ())}, key=str)
        out += new
        held += [(*r, RUN.load_ts) for r in new]
    return out


def one_by_one_sets(target, stages):
    held, out = [(*r, p) for r, p in zip(target, positions(target, lambda r: (r[0], r[3])))], []
    for s in stages:
        new = []
        for hk in sorted({r[0] for r in s}):
            rows = [r for r in s if r[0] == hk]
            own = {r[2] for r in rows}
            mine = [r for r in held if r[0] == hk]
            newest = max((age(r[3]) for r in mine), default=None)
            group = [r for r in mine if age(r[3]) == newest]
            same = (group and newest[0] == 0 and max(r[4] for r in group) == len(own) and own <= {r[2] for r in group})
            if not same:
                place = {v: i + 1 for i, v in enumerate(sorted(own, key=digest))}
                new += [(*r, place[r[2]]) for r in rows]
        out += new
        held += [(r[0], r[1], r[2], RUN.load_ts, r[3]) for r in new]
    return out


def positions(rows, group):
    sets = {}
    for r in rows:
        sets.setdefault(group(r), set()).add(r[2])
    ranks = {g: {v: i + 1 for i, v in enumerate(sorted(vs, key=digest))} for g, vs in sets.items()}
    return [ranks[group(r)][r[2]] for r in rows]


def frames(spark, target, stages, multi):
    import datetime as dt

    at = lambda t: None if t is None else dt.datetime.fromisoformat(t)
    meta = lambda t: (at(t), at(t), "x", "default", "default")
    rows = [(hk, ck, v, digest(v), *meta(t)) for hk, ck, v, t in target]
    if multi:
        rows = [(*r, p) for r, p in zip(rows, positions(target, lambda r: (r[0], r[3])))]
    tgt = spark.createDataFrame(rows, STAGED + (", dv_subseq int" if multi else ""))
    return tgt, [spark.createDataFrame([(*r, digest(r[2]), *meta(RUN.load_ts)) for r in s], STAGED) for s in stages]


@pytest.mark.parametrize("n_sources,at_once", [(1, 16), (4, 16), (5, 2)])
def test_child_key_sources_load_as_one_after_another(spark, monkeypatch, n_sources, at_once):
    monkeypatch.setattr(load, "SOURCES_AT_ONCE", at_once)
    target, stages = scenarios(n_sources, seed=n_sources)
    tgt, st = frames(spark, target, stages, multi=False)
    got = sat_delta(st, tgt, CKEY, RUN).collect()
    assert sorted(map(str, [(r["hk"], r["ck"], r["v"]) for r in got])) == sorted(map(str, one_by_one_ckey(target, stages)))
    assert {str(r["dv_loadts"]) for r in got} == {RUN.load_ts}


@pytest.mark.parametrize("n_sources,at_once", [(1, 16), (4, 16), (5, 2)])
def test_multi_active_sources_load_as_one_after_another(spark, monkeypatch, n_sources, at_once):
    monkeypatch.setattr(load, "SOURCES_AT_ONCE", at_once)
    target, stages = scenarios(n_sources, seed=10 + n_sources)
    tgt, st = frames(spark, target, stages, multi=True)
    got = sat_delta([s.drop("ck") for s in st], tgt.drop("ck"), MULTI, RUN).collect()
    want = [(hk, v, p) for hk, _, v, p in one_by_one_sets(target, stages)]
    assert sorted((r["hk"], r["v"], r["dv_subseq"]) for r in got) == sorted(want)


def test_first_load_of_several_sources(spark):
    _, stages = scenarios(3, seed=3)
    _, st = frames(spark, [], stages, multi=False)
    got = sat_delta(st, None, CKEY, RUN).collect()
    assert sorted(map(str, [(r["hk"], r["ck"], r["v"]) for r in got])) == sorted(map(str, one_by_one_ckey([], stages)))
    got = sat_delta([s.drop("ck") for s in st], None, MULTI, RUN).collect()
    want = [(hk, v, p) for hk, _, v, p in one_by_one_sets([], stages)]
    assert sorted((r["hk"], r["v"], r["dv_subseq"]) for r in got) == sorted(want)


def shuffles(spark, make):
    """Hash exchanges that run: planned without AQE, equal ones show as reused."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return len(re.findall(r"[- ] Exchange hashpartitioning", plan_text(make(), "simple")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_exchanges_do_not_grow_with_the_sources(spark, monkeypatch):
    monkeypatch.setattr(prune, "PRUNE_FROM", 2**63)  # the bitmap has one more of its own
    target, stages = scenarios(6, seed=1, keys=5)
    for sat, multi in ((CKEY, False), (MULTI, True)):
        tgt, st = frames(spark, target, stages, multi)
        counts = [shuffles(spark, lambda n=n: sat_delta(st[:n], tgt, sat, RUN)) for n in range(1, 7)]
        assert max(counts) <= (13 if multi else 10) and max(counts[1:]) == min(counts[1:]), counts


def test_sources_of_another_run_are_refused(spark):
    target, stages = scenarios(2, seed=2, keys=5)
    tgt, st = frames(spark, target, stages, multi=False)
    with pytest.raises(Exception, match="in one run"):
        sat_delta(st, tgt, CKEY, Run(load_ts=T[2])).collect()


def test_five_sources_plan_is_small(spark):
    assert shuffles(spark, lambda: load_sat_ckey_five_sources(spark, SF_SMALL)) <= 16
