"""Merkle manifest of a dataset over concatenated-level strings (native DataFrame operations).

Every row is hashed to a leaf. The leaves of a tree (say, of a source) are numbered in order
and dealt to aligned blocks of ``FANOUT ** HEIGHT`` neighbours. A block keeps each of its levels as
one hex string: the digests of the level's nodes, 64 characters each, one behind the other.
Hashing the fixed-width substrings of a level (those of ``FANOUT`` digests) gives the next
one, up to the block's single tip. The substrings that flank a node inside its run are its
sibling segments. The tips of a tree's blocks are the leaves of the next round of blocks, so
the trees of any size take as many rounds as their logarithm needs; the trees' roots, in
order, are the leaves of one more tree, whose root stands for the dataset.

Leaves are numbered without a sort in one task: a range partitioning by (tree, order, hash,
row) puts them in order, and the number of a leaf is its place in its partition plus the
tree's leaves in the partitions before. So a hot tree, or many rows of one order value, are
split like others. Blocks are bounded, and so is every group and window.

Defined results: a null value is hashed as ``-``; leaves with a null order value come first; rows of
one order value are ordered by their hash; equal rows are leaves each; a null tree value is a tree of
its own, the first one; an empty table has no leaves and no root; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import keep, partitions, table

FANOUT = 3
#: Levels of a block above its leaves: a block has at most FANOUT ** HEIGHT leaves.
HEIGHT = 6
DIGEST = 64
_PATH = "array<struct<left: binary, right: binary>>"


def row_hash(values: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the values, each as its byte count, a colon and its UTF-8 bytes, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
             for v in values]
    return F.sha2(F.concat(*parts), 256)


def tree_key(value: Column) -> Column:
    """A key without nulls that sorts as the value does, null first and then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def tree_value(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 2**31 - 1))


# ------------------------------------------------------- numbering
def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (tree, order, hash, ...) with ``pos``, the row's number in its tree, and ``size``, the tree's rows."""
    tagged = keep(rows.withColumn("_row", F.monotonically_increasing_id()), f"{label}-rows")
    order = ["tree", "order", "hash", "_row"]
    placed = keep(tagged.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()).drop("_row", "order"), f"{label}-placed")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by_part = Window.partitionBy("tree").orderBy("_part")  # as many rows as there are partitions, at most
    before = F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select("tree", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), whole.alias("size"))
    return (placed.join(parts, ["tree", "_part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before"))


# ------------------------------------------------------- blocks of levels
def _digests(level: Column, first: Column, count: Column | int) -> Column:
    """``count`` digests of a level from number ``first`` on (fewer at its end)."""
    return F.substr(level, (first * DIGEST + 1).cast("int"), (F.lit(count) * DIGEST).cast("int"))


def _parents(level: Column, fanout: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (DIGEST * fanout)).cast("int"))
    return F.array_join(F.transform(runs, lambda r: F.sha2(_digests(level, r * fanout, fanout), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """(tree, block, size, items, levels) of nodes (tree, pos, size, hash, item): items and the lowest level lie in order."""
    held = nodes.withColumn("block", F.floor(F.col("pos") / fanout**height).cast("long"))
    grouped = held.groupBy("tree", "block").agg(F.first("size").alias("size"),
                                                F.sort_array(F.collect_list(F.struct("pos", "hash", "item"))).alias("nodes"))
    lowest = F.array_join(F.transform("nodes", lambda x: x["hash"]), "").cast("binary")
    top = lambda levels: F.element_at(levels, -1)
    goes_on = lambda levels: (F.col("size") > fanout**height) | (F.octet_length(top(levels)) > DIGEST)
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(height)), F.array(lowest),
        lambda levels, _: F.when(goes_on(levels), F.concat(levels, F.array(_parents(top(levels), fanout)))).otherwise(levels))
    return grouped.select("tree", "block", "size", F.transform("nodes", lambda x: x["item"]).alias("items"), levels.alias("levels"))


class Forest:
    """Merkle trees over the rows of ``nodes`` (tree, pos, size, hash, item).

    ``rounds`` are the tables of blocks, those of the leaves first; ``roots`` has (tree, root).
    """

    def __init__(self, nodes: DataFrame, label: str, fanout: int = FANOUT, height: int = HEIGHT):
        self.fanout, self.height, self.rounds = fanout, height, []
        most = None
        while most is None or most > 1:
            blocks = keep(_blocks(nodes, fanout, height), f"{label}-{len(self.rounds)}", "zstd")
            self.rounds.append(blocks)
            tip = F.element_at("levels", -1).cast("string").alias("hash")
            n_blocks = F.ceil(F.col("size") / fanout**height).cast("long")
            tips = blocks.select("tree", F.col("block").alias("pos"), n_blocks.alias("size"), tip, F.lit(None).cast("int").alias("item"))
            nodes = tips.where("size > 1")
            most = tips.agg(F.max("size")).first()[0] or 1
        # A tree ends in the round in which it has a single block.
        single = [b.where(F.col("size") <= fanout**height).select("tree", F.element_at("levels", -1).cast("string").alias("root"))
                  for b in self.rounds]
        self.roots = single[0]
        for s in single[1:]:
            self.roots = self.roots.unionByName(s)

    def _paths(self, blocks: DataFrame) -> DataFrame:
        """(tree, block, pos in block, hash, item, path) of all nodes of blocks with a column ``up``."""
        def segment(level, k, j):
            own = F.floor(j / F.pow(F.lit(float(self.fanout)), k)).cast("int")
            run = own - own % self.fanout
            return F.struct(_digests(level, run, own - run).alias("left"),
                            _digests(level, own + 1, run + (self.fanout - 1) - own).alias("right"))

        inner = F.slice("levels", F.lit(1), F.size("levels") - 1)  # all but the tip
        own_path = lambda j: F.transform(inner, lambda level, k: segment(level, k, j))
        node = lambda item, j: F.struct(
            j.alias("j"), _digests(F.element_at("levels", 1), j, 1).cast("string").alias("hash"), item.alias("item"),
            F.concat(own_path(j), "up").alias("path"))
        return blocks.select("tree", "block", F.explode(F.transform("items", node)).alias("n")).select("tree", "block", "n.*")

    def leaves(self, above: DataFrame) -> DataFrame:
        """(tree, hash, item, path) of all leaves; ``above`` has (tree, root's path ``up``) of all trees.

        ``path`` lists, from the leaf upwards, the digests left and right of it in its run.
        """
        ups, n = None, self.fanout**self.height
        for blocks in reversed(self.rounds):
            ending = blocks.where(F.col("size") <= n).join(above, "tree")
            inside = blocks.where(F.col("size") > n)
            held = ending if ups is None else ending.unionByName(inside.join(ups, ["tree", "block"]))
            found = self._paths(held)
            # The node number pos of this round is the block of that number in the round below.
            ups = found.select("tree", (F.col("block") * n + F.col("j")).alias("block"), F.col("path").alias("up"))
        return found.select("tree", "hash", "item", "path")


def no_path() -> Column:
    return F.array().cast(_PATH)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h.cast("binary"), s["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level upwards, from left to right."""
    return F.aggregate(path, F.lit("").cast("binary"), lambda text, s: F.concat(text, s["left"], s["right"]))


def manifest(rows: DataFrame, tree_col: str, order_col: str, hash_col: str, item: Column,
             fanout: int = FANOUT, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Leaves (value of ``tree_col`` as text ``tree``, ``leaf``, ``item``, ``subroot``, ``root``, ``path`` up to
    the root) and trees (``tree``, ``subroot``, ``root``) of a table whose rows have their hash in ``hash_col``.

    ``item`` is carried along with each leaf.
    """
    nodes = numbered(rows.select(tree_key(F.col(tree_col)).alias("tree"), F.col(order_col).alias("order"),
                                 F.col(hash_col).alias("hash"), item.alias("item")), "manifest")
    trees = Forest(nodes, "manifest-trees", fanout, height)
    subroots = keep(trees.roots, "manifest-subroots")
    # The trees' roots are the leaves of one tree, in the order of their keys.
    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("order"), F.col("root").alias("hash"),
                                    F.col("tree").alias("item")), "manifest-order")
    top = Forest(tops, "manifest-top", fanout, height)
    ends = top.leaves(top.roots.select("tree", no_path().alias("up"))).join(top.roots, "tree")
    above = keep(ends.select(F.col("item").alias("tree"), F.col("path").alias("up"), F.col("hash").alias("subroot"), "root"),
                 "manifest-above")
    known = above.select("tree", "subroot", "root")
    leaves = trees.leaves(above.select("tree", "up")).join(known, "tree")
    return (leaves.select(tree_value(F.col("tree")).alias("tree"), F.col("hash").alias("leaf"), "item", "subroot", "root", "path"),
            known.withColumn("tree", tree_value(F.col("tree"))))


# ---------------------------------------------------------------- query
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_level_string_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, each source a tree; texts with an even checksum of the id lose their
    line ends, and the root is recomputed from every such leaf."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    leaf = row_hash([F.col(c) for c in FIELDS])
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    damaged = F.when(hit, row_hash([F.translate(c, "\n", "") if c == "text" else F.col(c) for c in FIELDS]))
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), damaged.alias("damaged"))
    leaves, _ = manifest(rows, "source", "doc_id", "leaf", F.struct("doc_id", "damaged"))
    folded = fold(F.coalesce("item.damaged", "leaf"), F.col("path"))
    return leaves.select(F.col("item.doc_id").alias("doc_id"), "leaf", "subroot", "root",
                         F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")
                         ).withColumn("verified", F.col("folded_root") == F.col("root"))


# The trees level by level; a leaf's siblings and its folding by joins with the levels.
_HASHED = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ["doc_id", "source", "lang", "n_chars", "{text}"])
_CRC = """list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
        lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
                                 lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295)"""
_ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_HASHED.format(text="text")}) AS leaf,
            CASE WHEN xor({_CRC}, 4294967295) % 2 = 0 AND doc_id IS NOT NULL
                 THEN sha256({_HASHED.format(text="replace(text, chr(10), '')")})
                 ELSE sha256({_HASHED.format(text="text")}) END AS damaged FROM documents),
n0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
              count(*) OVER (PARTITION BY tree) AS n FROM d),
t AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM n0
      UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1
      GROUP BY tree, lvl, pos // 3, n),
s AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, n, subroot AS h FROM s
      UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1
      GROUP BY lvl, pos // 3, n),
height AS (SELECT tree, max(lvl) AS top FROM t GROUP BY tree),
levels AS (SELECT tree, lvl, pos, h FROM t JOIN height USING (tree) WHERE lvl < top
           UNION ALL SELECT tree, top + lvl, u.pos, h FROM height, u WHERE u.n > 1),
place AS (SELECT doc_id, leaf, tree, lvl, n0.pos // (3 ** lvl)::BIGINT AS pos FROM n0 JOIN height USING (tree), range(0, 60) r(lvl) WHERE lvl < top
          UNION ALL SELECT doc_id, leaf, tree, top + lvl, s.pos // (3 ** lvl)::BIGINT FROM n0 JOIN height USING (tree) JOIN s USING (tree),
                    (SELECT DISTINCT lvl FROM u WHERE n > 1)),
seg AS (SELECT p.doc_id, p.leaf, p.lvl, coalesce(string_agg(l.h, '' ORDER BY l.pos) FILTER (l.pos < p.pos), '') AS lefts,
               coalesce(string_agg(l.h, '' ORDER BY l.pos) FILTER (l.pos > p.pos), '') AS rights
        FROM place p JOIN levels l ON l.tree = p.tree AND l.lvl = p.lvl AND l.pos // 3 = p.pos // 3 GROUP BY p.doc_id, p.leaf, p.lvl),
f AS (SELECT doc_id, leaf, 0 AS lvl, damaged AS h FROM n0
      UNION ALL SELECT f.doc_id, f.leaf, f.lvl + 1, sha256(lefts || h || rights) FROM f JOIN seg
                ON seg.doc_id = f.doc_id AND seg.leaf = f.leaf AND seg.lvl = f.lvl),
ends AS (SELECT doc_id, leaf, max_by(h, lvl) AS folded_root FROM f GROUP BY ALL),
proofs AS (SELECT doc_id, leaf, sha256(string_agg(lefts || rights, '' ORDER BY lvl)) AS proof_sha256 FROM seg GROUP BY ALL)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM n0 JOIN s USING (tree) JOIN (SELECT h AS root FROM u WHERE n = 1) ON true JOIN ends USING (doc_id, leaf)
LEFT JOIN proofs USING (doc_id, leaf)"""

QUERIES = {"op13_level_string_manifest": op13_level_string_manifest}
ORACLE = {"op13_level_string_manifest": _ORACLE}
