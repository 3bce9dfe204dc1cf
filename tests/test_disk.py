"""What loads shuffle and leave on disk: no more than the load needs."""

import re
import time

from pyspark.sql import functions as F

from vaultsmith import Run, Source, VaultModel
from vaultsmith.functions.keys import pack, unpack, whole_digest
from vaultsmith.functions.prune import no_rows
from vaultsmith.operators.effectivity import _distinct_by, effectivity_delta
from vaultsmith.operators.load import _placed_sets, _tagged, link_delta, sat_delta
from vaultsmith.plans.explain import plan_summary, plan_text
from vaultsmith.plans.runner import VaultRunner
from vaultsmith.session import CLEANUP
from vaultsmith.sinks.tables import append, ensure_table, table_columns
from vaultsmith.sources.tables import mapping_sources
from vaultsmith.spec import Effectivity, Link

from .test_many_sources import CKEY, MULTI, frames, scenarios, shuffles

RUN = Run(load_ts="2024-06-01 00:00:00")
LINK = Link("l", hk="hk", hks=["a_hk", "b_hk"], cks={"c": "ck"}, sources=[Source("x", bks={"a": "a_hk", "b": "b_hk"})])


def links(spark, keys):
    names = ["hk", "a_hk", "b_hk", "ck", "dv_recsrc", "dv_tenant", "dv_bkeycode"]
    return spark.createDataFrame([(h, "0a" * 16, None, c, "r", "t", "c") for h, c in keys], ", ".join(f"{n} string" for n in names)
                                 ).withColumn("dv_appts", F.lit(None).cast("timestamp_ntz"))


def test_reference_link_loads_shuffle_packed_digests(spark):
    known, new, short = "00ff" * 8, "ff00" * 8, "a"
    staged = links(spark, [(known, "1"), (new, "1"), (new, "1"), (short, "1"), ("b", None), (None, "1"), (None, "1")])
    target = links(spark, [(known, "1"), (known, "2"), (short, "1"), (None, "1")])
    delta = link_delta(staged, target, LINK, RUN)
    plan = plan_text(delta, "simple")
    assert plan.index("lower(hex(") < plan.index("Join") < plan.rindex("unhex(")  # read back above the join, packed beneath
    # Copies of a new key all load, a NULL never matches.
    assert sorted((str(r["hk"]), r["a_hk"], r["b_hk"], str(r["ck"])) for r in delta.collect()) == sorted(
        (h, "0a" * 16, None, c) for h, c in [(new, "1"), (new, "1"), ("b", "None"), ("None", "1"), ("None", "1")])


def test_the_first_load_of_a_link_shuffles_nothing(spark, scratch_db):
    name = f"{scratch_db}.l"
    ensure_table(spark, name, table_columns(LINK))
    target = spark.table(name).select("hk")
    assert no_rows(target) and not no_rows(spark.range(1)) and not no_rows(spark.range(3).where("id > 9").distinct())
    staged = links(spark, [("a", "1"), ("a", "1"), (None, "1")])
    first = link_delta(staged, target, LINK, RUN)
    assert plan_summary(first)["exchanges"] == 0
    append(first, name)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 3
    second = link_delta(links(spark, [("a", "1"), ("b", "1")]), spark.table(name).select("hk"), LINK, RUN)
    assert [r["hk"] for r in second.collect()] == ["b"]


EFF = Effectivity("es", link="l", drivers=["a_hk"])


def test_relations_are_dealt_by_their_key_once(spark):
    rows = links(spark, [("a", "1"), ("a", "1"), ("b", "1"), (None, "1"), (None, "1")]).withColumn("a_hk", F.coalesce("hk", F.lit("n")))
    distinct = _distinct_by(rows.select("hk", "a_hk", "dv_recsrc"), "hk")
    assert sorted(map(tuple, distinct.collect()), key=str) == [("a", "a", "r"), ("b", "b", "r"), (None, "n", "r")]
    target = effectivity_delta(links(spark, [("a", "1"), ("c", "1")]).withColumn("a_hk", F.col("hk")), None, None, EFF, LINK, RUN)
    known = links(spark, [("a", "1"), ("c", "1")]).withColumn("a_hk", F.col("hk"))
    target = spark.createDataFrame(target.collect(), target.schema)
    delta = effectivity_delta(rows, target, known, EFF, LINK, RUN)
    assert plan_summary(delta)["exchanges"] == 5  # records, link keys, relations; what began or ended and the drivers
    assert sorted((str(r["hk"]), str(r["dv_endts"])[:4]) for r in delta.collect()) == [("None", "9999"), ("b", "9999")]


def test_a_run_leaves_no_shuffle_files(spark, scratch_db):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    held = lambda: {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("|").split("|") if "shuffle_" in f}
    model = VaultModel.from_yaml("""
connection: {schemas: {source: unused, stage: %(db)s, edwh: %(db)s}}
rv:
  sats:
    s_x: {hk: hk, attrs: [v], cks: {}, multiactive: true, src: {x: {bks: [id], attrs: {v: v}}}}
""" % {"db": scratch_db})
    before = held()
    rows = spark.range(100).select((F.col("id") % 10).alias("id"), F.col("id").cast("string").alias("v"))
    VaultRunner(spark, model, sources=mapping_sources({"x": rows}), tune_session=False).run(RUN)
    for _ in range(50):  # files go in the background
        if not held() - before:
            break
        time.sleep(0.2)
    assert not held() - before and spark.table(f"{scratch_db}.s_x").count() == 100
    assert spark.conf.get(CLEANUP, None) is None


def test_a_hashdiff_of_its_attributes_is_not_shuffled(spark):
    texts = [("1", "2"), ("1|2", None), (None, "1|2"), (None, None), ("", "")]
    own = F.md5(F.concat_ws("|", "a", "b"))
    rows = spark.createDataFrame(texts, "a string, b string")
    rows = rows.withColumn("d", own).unionByName(rows.withColumn("d", F.md5(F.lit("other")))).unionByName(
        rows.withColumn("d", F.lit(None).cast("string"))).unionByName(rows.withColumn("d", F.lit(""))).unionByName(rows.withColumn("d", F.lit("A")))
    packed = pack(rows, ["d"], "d", ["a", "b"])
    assert packed.where("length(d) = 0").count() == len(texts)
    assert unpack(packed, ["d"], "d", ["a", "b"]).collect() == rows.collect()
    assert packed.distinct().count() == rows.distinct().count() == 25
    assert packed.withColumn("d", whole_digest("d", ["a", "b"])).collect() == pack(rows, ["d"]).collect()


def test_child_key_loads_do_not_shuffle_hashdiffs(spark):
    """By the plan: the staged hashdiffs are dropped before the exchange and made again behind it."""
    target, stages = scenarios(2, seed=3, keys=5)
    tgt, st = frames(spark, target, stages, False)
    for delta in (sat_delta(st, tgt, CKEY, RUN), sat_delta(st[0], None, CKEY, RUN)):
        assert re.search(r"dv_hashdiff#\d+ = md5\(", plan_text(delta, "simple"))


def test_sets_are_compared_and_loaded_from_one_shuffle(spark):
    target, stages = scenarios(3, seed=5, keys=40)
    tgt, st = frames(spark, target, stages, True)
    tagged, tgt = _tagged([s.drop("ck") for s in st]), tgt.drop("ck")
    for n, run in ((3, RUN), (1, RUN), (1, Run(load_ts="2024-06-01 00:00:00", semantics="strict"))):
        rows = tagged.where(f"_src_ord < {n}")
        assert shuffles(spark, lambda: _placed_sets(rows, tgt, MULTI.hk, n, run)) == 1
