"""The manifest against trees built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vaultsmith.llm import manifest as m


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves, fanout):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def proof(levels, k, fanout):
    out = []
    for level in levels[:-1]:
        run = level[k - k % fanout:k - k % fanout + fanout]
        out += run[:k % fanout] + run[k % fanout + 1:]
        k //= fanout
    return out


def text_hash(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string, item string"


def rows():
    out = [(k * 3, f"s{k % 4 if k % 3 else 0}", None, k, f"text {k}\nline") for k in range(120)]
    out += [(5000 + k, "hot", "é", None, "x\n" * k) for k in range(100)]
    out += [(7, "one", "en", 1, "lone leaf"), (8, None, None, None, None), (None, None, "a", 3, ""), (None, None, "a", 4, "no id"),
            (9, "", "en", 0, ""), (9, "", "en", 0, ""), (9, "", "en", 1, "same id"), (10, "üx", "y" * 10, 2, "漢字\n" * 50_000), (11, "zz", "", -5, "\n")]
    return out


@pytest.mark.parametrize("fanout,height", [(3, 6), (3, 1), (2, 2)])
def test_manifest_equals_plain_trees(spark, fanout, height):
    data = rows()
    df = spark.createDataFrame([(*r, "t", "l", "i") for r in data], SCHEMA)
    hashed = df.withColumn("digest", m.row_hash([F.col(c) for c in m.FIELDS]))
    leaves, trees = m.manifest(hashed, "source", "doc_id", "digest", F.struct("doc_id"), fanout, height)
    got = leaves.select("tree", "leaf", "item.doc_id", "subroot", "root", F.sha2(m.siblings(F.col("path")), 256).alias("proof"),
                        m.fold(F.col("leaf"), F.col("path")).alias("again"),
                        m.fold(F.lit("0" * 64), F.col("path")).alias("other")).collect()
    by_tree = {}
    for r in data:
        by_tree.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, text_hash(r), r[0]))
    order = sorted(by_tree, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: tree([x[2] for x in sorted(by_tree[s], key=lambda x: x[:3])], fanout) for s in order}
    top = tree([levels[s][-1][0] for s in order], fanout)
    expected = []
    for at, s in enumerate(order):
        for k, x in enumerate(sorted(by_tree[s], key=lambda x: x[:3])):
            path = proof(levels[s], k, fanout) + proof(top, at, fanout)
            expected.append((s, x[2], x[3], levels[s][-1][0], top[-1][0], h(*path)))
    assert sorted(map(repr, [tuple(r)[:6] for r in got])) == sorted(map(repr, expected))
    assert all(r["again"] == r["root"] and r["other"] != r["root"] for r in got)
    assert sorted(map(repr, [(r["tree"], r["subroot"], r["root"]) for r in trees.collect()])) == sorted(
        map(repr, [(s, levels[s][-1][0], top[-1][0]) for s in order]))


def test_many_rows_of_one_order_value_are_split(spark):
    """Null ids, all in one tree: numbered in several partitions."""
    df = spark.range(20_000).select(F.lit("=a").alias("tree"), F.lit(None).cast("long").alias("order"),
                                    F.sha2((F.col("id") % 9).cast("string"), 256).alias("hash"), F.lit(1).alias("item"))
    out = m.numbered(df, "test")
    rows_ = out.select("pos", "hash", "size").collect()
    assert sorted(r["pos"] for r in rows_) == list(range(20_000)) and {r["size"] for r in rows_} == {20_000}
    ordered = [r["hash"] for r in sorted(rows_, key=lambda r: r["pos"])]
    assert ordered == sorted(ordered)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(*r, "t", "l", "i") for r in rows()[:1]], SCHEMA).withColumn("digest", F.lit("a" * 64))
    leaves, trees = m.manifest(df, "source", "doc_id", "digest", F.col("doc_id"))
    r = leaves.first()
    assert r["root"] == r["subroot"] == r["leaf"] == "a" * 64 and r["path"] == []
    leaves, trees = m.manifest(df.where("false"), "source", "doc_id", "digest", F.col("doc_id"))
    assert leaves.count() == 0 and trees.count() == 0


def test_query_tampers_by_checksum(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in m.op13_level_string_manifest(spark, sf).collect():
        d = docs[r["doc_id"]]
        touched = zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0 and "\n" in (d["text"] or "")
        assert r["leaf"] == text_hash([d[c] for c in m.FIELDS]) and r["verified"] == (not touched)
