"""Fixity audit of WARC replicas with Merkle trees (native DataFrame operations).

A replica's records are hashed; a page's record hashes make its leaf; leaves of ``FANOUT``
consecutive page ids are an ordered offset range whose hash covers theirs in order, ranges
form wider ranges, up to the root. A file holds the pages of ``FANOUT ** FILE_LEVEL``
consecutive ids, so a file is a node too. As ranges go by id, a lost record changes only
its own branch, although it moves the offsets behind it. Every level is a table
(node, hash) made by one aggregate over groups of at most ``FANOUT`` rows.

Two replicas are compared from the root: where hashes are equal the subtree is skipped,
and only children of differing nodes are read on the level below. The leaves that remain
are the damaged pages, with their offset ranges in both replicas.

Defined results: null url or html is empty; pages without id share the leaf -1; equal
repeated records are one entry with a count; records of one id with different contents
share its leaf (their hashes are folded by hash prefix first, so many of them do not meet
in one group); if one replica lacks a page it is missing or extra; of empty tables the
audit is empty; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import keep, table

FANOUT = 16
FILE_LEVEL = 3
PREFIX = 3


def warc_payload(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a response record: header block, body, two line ends."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    header = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                      page_id.cast("string"), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                      F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(header, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def records(pages: DataFrame) -> DataFrame:
    """(page_id, digest, length, copies) of the distinct records; only these narrow rows are shuffled."""
    page_id = F.coalesce(F.col("page_id").cast("long"), F.lit(-1).cast("long"))
    payload = pages.select(page_id.alias("page_id"), "url", "html").select(
        "page_id", warc_payload(F.col("page_id"), F.col("url"), F.col("html")).alias("payload"))
    hashed = payload.select("page_id", F.sha2("payload", 256).alias("digest"),
                            F.octet_length("payload").cast("long").alias("length"))
    return hashed.groupBy("page_id", "digest", "length").agg(F.count(F.lit(1)).alias("copies"))


def _fold(df: DataFrame, keys: list[str], item: Column) -> DataFrame:
    """(keys, hash of the group's items in order)."""
    listed = F.sort_array(F.collect_list(item))
    return df.groupBy(*keys).agg(F.sha2(F.concat_ws("\n", F.transform(listed, lambda x: x["hash"])), 256).alias("hash"))


def leaves(recs: DataFrame) -> DataFrame:
    """(node = page id, hash, offset, length): a page's records lie together in its file."""
    entry = F.struct("digest", F.concat_ws(":", "digest", F.col("copies").cast("string")).alias("hash"))
    by_prefix = _fold(recs.withColumn("prefix", F.substring("digest", 1, PREFIX)), ["page_id", "prefix"], entry)
    hashes = _fold(by_prefix, ["page_id"], F.struct("prefix", "hash"))
    sizes = recs.groupBy("page_id").agg(F.sum(F.col("length") * F.col("copies")).alias("length"))
    file = F.floor(F.col("page_id") / FANOUT**FILE_LEVEL)
    w = Window.partitionBy(file).orderBy("page_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.withColumn("offset", F.sum("length").over(w) - F.col("length"))
    return hashes.join(placed, "page_id").select(F.col("page_id").alias("node"), "hash", "offset", "length")


def _parent() -> Column:
    return F.floor(F.col("node") / FANOUT).cast("long")


def trees(a: DataFrame, b: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The levels of both replicas' trees, leaves first, equally high; each kept as a table."""
    levels = [[keep(leaves(records(x)), f"warc-{name}-0")] for x, name in ((a, "a"), (b, "b"))]
    while any(side[-1].where("node NOT IN (0, -1)").limit(1).count() for side in levels):
        for side, name in zip(levels, "ab"):
            above = _fold(side[-1].withColumn("parent", _parent()), ["parent"], F.struct("node", "hash"))
            side.append(keep(above.withColumnRenamed("parent", "node"), f"warc-{name}-{len(side)}"))
    return levels[0], levels[1]


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    left = a.select("node", F.struct(*[c for c in a.columns if c != "node"]).alias("a"))
    right = b.select("node", F.struct(*[c for c in b.columns if c != "node"]).alias("b"))
    return left.join(right, "node", "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """The pages (tables page_id, url, html) on which replica ``b`` differs from ``a``: kind
    (changed, missing, extra), file, page_id, and offset, length and hash on both sides.
    """
    ta, tb = trees(a, b)
    found = _differing(ta[-1], tb[-1])
    for k in range(len(ta) - 2, -1, -1):
        bad = keep(found.select(F.col("node").alias("parent")), f"warc-differing-{k + 1}")
        below = [x[k].withColumn("parent", _parent()).join(bad, "parent", "left_semi").drop("parent") for x in (ta, tb)]
        found = _differing(*below)
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    sides = [F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("offset", "length", "hash")]
    return found.select(kind.alias("kind"), F.floor(F.col("node") / FANOUT**FILE_LEVEL).cast("long").alias("file"),
                        F.col("node").alias("page_id"), *sides)


# ---------------------------------------------------------------- query
def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as replica a; replica b has them with damage that depends on the id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    hit = lambda n, r: F.coalesce(F.pmod("page_id", F.lit(n)) == r, F.lit(False))
    html = (F.when(hit(97, 13), F.concat(F.lit("?"), F.substring("html", 2, F.length("html"))))
            .when(hit(193, 7), F.substring("html", 1, F.greatest(F.length("html") - 1, F.lit(0)))).otherwise(F.col("html")))
    a = pages.where(~hit(601, 5))
    b = pages.where(~hit(389, 11)).withColumn("html", html)
    return audit(a, b)


def _side(rows: str, html: str) -> str:
    return f"""SELECT page_id, sha256(p) AS digest, strlen(p) AS length FROM (
        SELECT page_id, 'WARC/1.1' || n || 'WARC-Type: response' || n || 'WARC-Record-ID: <urn:page:' || page_id || '>' || n ||
               'WARC-Target-URI: ' || coalesce(url, '') || n || 'Content-Length: ' || strlen(h) || n || n || h || n || n AS p
        FROM (SELECT coalesce(page_id, -1) AS page_id, url, coalesce({html}, '') AS h, chr(13) || chr(10) AS n FROM pages WHERE {rows}))"""


def _tree(side: str) -> str:
    return f"""
{side}1 AS (SELECT page_id, digest, length, count(*) AS copies FROM {side}0 GROUP BY ALL),
{side}2 AS (SELECT page_id, left(digest, 3) AS prefix, sha256(string_agg(digest || ':' || copies, chr(10) ORDER BY digest)) AS hash
       FROM {side}1 GROUP BY ALL),
{side}3 AS (SELECT page_id, sha256(string_agg(hash, chr(10) ORDER BY prefix)) AS hash FROM {side}2 GROUP BY ALL),
{side}4 AS (SELECT page_id, sum(length * copies)::BIGINT AS length FROM {side}1 GROUP BY ALL),
{side} AS (SELECT page_id, hash, length, (sum(length) OVER (PARTITION BY floor(page_id / 4096) ORDER BY page_id) - length)::BIGINT AS offs
       FROM {side}3 JOIN {side}4 USING (page_id))"""


_DAMAGED = ("CASE WHEN page_id % 97 = 13 THEN '?' || substr(html, 2) "
            "WHEN page_id % 193 = 7 THEN left(html, greatest(length(html) - 1, 0)) ELSE html END")
_ORACLE = f"""
WITH a0 AS ({_side("coalesce(page_id % 601 <> 5, true)", "html")}),
b0 AS ({_side("coalesce(page_id % 389 <> 11, true)", _DAMAGED)}),{_tree("a")},{_tree("b")}
SELECT CASE WHEN b.hash IS NULL THEN 'missing' WHEN a.hash IS NULL THEN 'extra' ELSE 'changed' END AS kind,
       floor(page_id / 4096)::BIGINT AS file, page_id, a.offs AS offset_a, a.length AS length_a, a.hash AS hash_a,
       b.offs AS offset_b, b.length AS length_b, b.hash AS hash_b
FROM a FULL JOIN b USING (page_id) WHERE a.hash IS DISTINCT FROM b.hash"""

QUERIES = {"op3_merkle_fixity": op3_merkle_fixity}
ORACLE = {"op3_merkle_fixity": _ORACLE}
