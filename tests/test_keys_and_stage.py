"""Golden tests: key text, hash keys and the stagers' quirks, on hand-written rows."""

import hashlib

import pytest

from vaultsmith import Hub, Link, Run, Sat, Source, stage_hub, stage_link, stage_sat
from vaultsmith.plans.explain import plan_summary

RUN = Run(load_ts="2024-06-01 00:00:00")
STRICT = Run(load_ts="2024-06-01 00:00:00", semantics="strict")


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


HUB = Hub("h_x", "hk_x", "x_bk", [Source("src", bks=["k"])])


def test_key_text_null_blank_tab(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("\tA ",), (" b ",)], "k string")
    rows = {r.x_bk: r.hk_x for r in stage_hub(df, HUB, HUB.sources[0], RUN).collect()}
    # NULL -> zero key; blank -> ''; only spaces are trimmed, a tab stays.
    assert set(rows) == {"-1", "", "\tA", "b"}
    assert rows["-1"] == md5("default|default|-1")
    assert rows[""] == md5("default|default|")
    assert rows["\tA"] == md5("default|default|\tA")


def test_key_cut_to_256_characters(spark):
    long_a = "a" * 256 + "X" * 44
    long_b = "a" * 256 + "Y" * 44
    df = spark.createDataFrame([(long_a,), (long_b,)], "k string")
    rows = stage_hub(df, HUB, HUB.sources[0], RUN).collect()
    assert rows[0].hk_x == rows[1].hk_x == md5("default|default|" + "a" * 256)
    assert len(rows[0].x_bk) == 256


def test_composite_key_delimiter_is_not_escaped(spark):
    hub = Hub("h_c", "hk_c", "c_bk", [Source("src", bks=["k1", "k2"], tenant="t1", bkeycode="c1")])
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "k1 string, k2 string")
    rows = stage_hub(df, hub, hub.sources[0], RUN).collect()
    assert rows[0].c_bk == rows[1].c_bk == "a|b|c"
    assert rows[0].hk_c == rows[1].hk_c == md5("t1|c1|a|b|c")


def test_numbers_and_timestamps_as_key_text(spark):
    df = spark.sql("SELECT CAST(42 AS BIGINT) AS k UNION ALL SELECT CAST(7 AS BIGINT)")
    keys = sorted(r.x_bk for r in stage_hub(df, HUB, HUB.sources[0], RUN).collect())
    assert keys == ["42", "7"]
    ts = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' AS k")
    assert stage_hub(ts, HUB, HUB.sources[0], RUN).first().x_bk == "2024-01-02 03:04:05"


def test_stage_meta_columns(spark):
    df = spark.createDataFrame([("1",)], "k string")
    row = stage_hub(df, HUB, HUB.sources[0], RUN).first()
    assert str(row.dv_loadts) == "2024-06-01 00:00:00" and row.dv_appts == row.dv_loadts
    assert (row.dv_recsrc, row.dv_tenant, row.dv_bkeycode, row.dv_taskid) == ("src", "default", "default",
                                                                              "stage_h_x")


# ------------------------------------------------------------------- links
LINK = Link("l_ab", "hk_ab", ["hk_a", "hk_b", "hk_c"], cks={"ln": "ln_ck", "absent": "absent_ck"},
            sources=[Source("src", bks={"a": "hk_a", "b": "hk_b", "nope": "hk_c"})])


def test_link_zero_key_for_missing_column_and_child_key(spark):
    df = spark.createDataFrame([("1", "2", 7)], "a string, b string, ln int")
    r = stage_link(df, LINK, LINK.sources[0], RUN).first()
    assert r.hk_a == md5("default|default|1")
    assert r.hk_c == md5("default|default|-1")
    assert r.hk_ab == md5("default|default|1|2|-1")
    assert (r.ln_ck, r.absent_ck) == ("7", "-1")


def test_link_hub_key_without_mapping_is_zero_key(spark):
    link = Link("l", "hk_l", ["hk_a", "hk_z"], sources=[Source("src", bks={"a": "hk_a"})])
    r = stage_link(spark.createDataFrame([("1",)], "a string"), link, link.sources[0], RUN).first()
    assert r.hk_z == md5("default|default|-1") and r.hk_l == md5("default|default|1|-1")


def test_link_composite_hub_key_equals_hub_hash(spark):
    link = Link("l", "hk_l", ["hk_line", "hk_p"],
                sources=[Source("src", bks={"o": "hk_line", "n": "hk_line", "p": "hk_p"})])
    hub = Hub("h_line", "hk_line", "line_bk", [Source("src", bks=["o", "n"])])
    df = spark.createDataFrame([("10", "3", "99")], "o string, n string, p string")
    r = stage_link(df, link, link.sources[0], RUN).first()
    h = stage_hub(df, hub, hub.sources[0], RUN).first()
    assert r.hk_line == h.hk_line == md5("default|default|10|3")
    assert r.hk_l == md5("default|default|10|3|99")


def test_link_first_column_missing_reference_vs_strict(spark):
    link = Link("l", "hk_l", ["hk_line"], sources=[Source("src", bks={"gone": "hk_line", "n": "hk_line"})])
    df = spark.createDataFrame([("3",)], "n string")
    ref = stage_link(df, link, link.sources[0], RUN).first()
    strict = stage_link(df, link, link.sources[0], STRICT).first()
    assert ref.hk_line == md5("default|default|-1")  # whole composite -> one zero key
    assert strict.hk_line == md5("default|default|-1|3")  # each missing column -> zero key


def test_business_link_hub_keys_unsalted_in_reference(spark):
    link = Link("l", "hk_l", ["hk_a", "hk_b"], sources=[Source("q", bks={"a": "hk_a", "b": "hk_b"},
                                                               tenant="t", bkeycode="c", sql="SELECT 1")])
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    ref = stage_link(df, link, link.sources[0], RUN, business=True).first()
    strict = stage_link(df, link, link.sources[0], STRICT, business=True).first()
    assert ref.hk_a == md5("1") and ref.hk_l == md5("t|c|1|2")
    assert strict.hk_a == md5("t|c|1")


def test_business_link_requires_columns(spark):
    link = Link("l", "hk_l", ["hk_a"], sources=[Source("q", bks={"a": "hk_a"}, sql="SELECT 1")])
    with pytest.raises(ValueError):
        stage_link(spark.createDataFrame([("1",)], "b string"), link, link.sources[0], RUN, business=True)


# -------------------------------------------------------------- satellites
SAT = Sat("s_x", "hk_x", ["first", "second", "third"], cks={"c": "c_ck"},
          sources=[Source("src", bks=["k"], attrs={"a1": "first", "a2": "second", "a3": "third"})])


def _sat_row(spark, data, run=RUN, sat=SAT, business=False):
    df = spark.createDataFrame([data], "k string, c string, a1 string, a2 string, a3 string")
    return stage_sat(df, sat, sat.sources[0], run, business=business).first()


def test_raw_sat_child_key_is_always_zero_key(spark):
    r = _sat_row(spark, ("1", "ck", "x", "y", "z"))
    assert r.c_ck == "-1"
    assert _sat_row(spark, ("1", "ck", "x", "y", "z"), STRICT).c_ck == "ck"


def test_business_sat_child_key_raw(spark):
    r = _sat_row(spark, ("1", None, "x", "y", "z"), business=True)
    assert r.c_ck is None
    assert _sat_row(spark, ("1", " ck ", "x", "y", "z"), business=True).c_ck == " ck "
    assert _sat_row(spark, ("1", None, "x", "y", "z"), STRICT, business=True).c_ck == "-1"


def test_hashdiff_untrimmed_raw_trimmed_business(spark):
    raw = _sat_row(spark, ("1", "c", " x ", "y", "z"))
    bv = _sat_row(spark, ("1", "c", " x ", "y", "z"), business=True)
    assert raw.first == " x " and raw.dv_hashdiff == md5(" x |y|z")
    assert bv.first == " x " and bv.dv_hashdiff == md5("x|y|z")
    strict = _sat_row(spark, ("1", "c", " x ", "y", "z"), STRICT)
    assert strict.first == "x" and strict.dv_hashdiff == md5("x|y|z")


def test_hashdiff_null_collision_and_strict_fix(spark):
    a = _sat_row(spark, ("1", "c", "a", None, "b"))
    b = _sat_row(spark, ("1", "c", "a", "b", None))
    assert a.dv_hashdiff == b.dv_hashdiff == md5("a|b")
    sa = _sat_row(spark, ("1", "c", "a", None, "b"), STRICT)
    sb = _sat_row(spark, ("1", "c", "a", "b", None), STRICT)
    assert sa.dv_hashdiff != sb.dv_hashdiff and sa.dv_hashdiff == md5("a||b")


def test_attributes_insert_by_position_in_reference(spark):
    sat = Sat("s", "hk", ["first", "second"], sources=[Source("src", bks=["k"], attrs={"a2": "second",
                                                                                         "a1": "first"})])
    df = spark.createDataFrame([("1", "one", "two")], "k string, a1 string, a2 string")
    ref = stage_sat(df, sat, sat.sources[0], RUN).first()
    strict = stage_sat(df, sat, sat.sources[0], STRICT).first()
    assert (ref.first, ref.second) == ("two", "one")  # map order fills attrs by position
    assert (strict.first, strict.second) == ("one", "two")
    assert ref.dv_hashdiff == md5("two|one")


def test_array_attribute_renders_like_database_text(spark):
    sat = Sat("s", "hk", ["tags"], sources=[Source("src", bks=["k"], attrs={"t": "tags"})])
    df = spark.createDataFrame([("1", ["a", "b"])], "k string, t array<string>")
    r = stage_sat(df, sat, sat.sources[0], RUN).first()
    assert r.tags == "{a,b}" and r.dv_hashdiff == md5("{a,b}")


def test_attribute_count_mismatch_rejected(spark):
    sat = Sat("s", "hk", ["one", "two"], sources=[Source("src", bks=["k"], attrs={"a": "one"})])
    with pytest.raises(ValueError):
        stage_sat(spark.createDataFrame([("1", "x")], "k string, a string"), sat, sat.sources[0], RUN)


def test_stage_is_a_single_projection(spark):
    df = spark.range(10).selectExpr("CAST(id AS STRING) AS k", "'c' AS c", "'x' AS a1", "'y' AS a2", "'z' AS a3")
    summary = plan_summary(stage_sat(df, SAT, SAT.sources[0], RUN))
    assert summary["exchanges"] == 0 and summary["forbidden"] == []


def test_source_resolvers_and_columns(spark):
    from vaultsmith.sources.tables import find_column, mapping_sources, parquet_sources, source_columns

    cust = parquet_sources(spark, "/root/testdata/sf0.001")("customer")
    assert source_columns(cust)[:2] == ["c_custkey", "c_name"]
    assert find_column(cust, "C_CUSTKEY") == "c_custkey" and find_column(cust, "nope") is None
    assert mapping_sources({"customer": cust})("customer") is cust
