"""Vector code compression with a lexicographic trie over distinct parts.

Vectors of integers are cut into equal parts; a part position's codebook has a few entries,
found by rounds of nearest-entry assignment and means; a vector's code is its parts' entry
numbers. All distances are measured once per distinct part, not once per vector.

The distinct parts of a position, in lexicographic order, are the leaves of a trie with one
level per dimension. A node carries, for all entries at once, the squared distance
over the dimensions of its prefix: its parent's vector plus one dimension's squares. The
traversal goes depth-first, so parts with a common prefix share the vectors accumulated on
the way and only one path of large nodes is held; a subtree of at most ``SUBTREE`` leaves is
finished level by level. At a leaf the least distance (the lower entry among equals) is
its assignment, and the part, weighted by how many vectors have it, goes into the entry's sum.

Parts are range-sorted by (position, part), so a task walks a contiguous stretch of a trie; it
returns one sum per entry and dimension. The codebooks (``parts`` * ``entries`` short vectors, whatever
the input's size) pass through the driver; parts and vectors don't. A part that more than
one in ``HOT`` vectors has (at most ``HOT`` a position) is looked up by broadcast, so no task
gets more than that share of them.

Defined results: rows whose vector is null or empty, or holds null or non-finite components, take no
part, nor do vectors whose length differs from that of the smallest id; that length must be a multiple of
``parts``. Every row is a vector, also with a repeated or null id (null ids come last, equal ids by
vector). With fewer rows than entries every row starts an entry. An empty table gives an empty
result. Distances and sums are exact while they fit a long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import keep, partitions, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
SUBTREE = 4096
HOT = 1024

#: Per part position: entries in order, each a list of integers.
Codebooks = list[list[list[int]]]


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, item: Column, scale: int = SCALE) -> DataFrame:
    """(row, id, item, v array<long>): floor(scale * component) of the usable rows."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return df.where((F.size(x) > 0) & F.forall(x, finite)).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), item.alias("item"),
        F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v"))


# ------------------------------------------------------- the trie
def walk(parts: np.ndarray, entries: np.ndarray, subtree: int = SUBTREE) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every row of ``parts``, which is in lexicographic order."""
    n, width = parts.shape
    best, least = np.empty(n, np.int64), np.empty(n, np.int64)
    # opens[k]: the row's first k + 1 values differ from the row before, a node of level k starts.
    opens = np.ones((width, n), bool)
    opens[:, 1:] = np.logical_or.accumulate((parts[1:] != parts[:-1]).T, axis=0)
    stack = [(0, 0, n, np.zeros((1, len(entries)), np.int64))]
    while stack:
        level, low, high, held = stack.pop()
        if high - low > subtree and level < width:
            heads = low + np.flatnonzero(opens[level, low + 1:high]) + 1
            bounds = [low, *heads.tolist(), high]
            for a, b in zip(bounds[-2::-1], bounds[:0:-1]):  # the first child on top
                stack.append((level + 1, a, b, held + (parts[a, level] - entries[:, level]) ** 2))
            continue
        starts = np.array([low])
        for k in range(level, width):
            first = opens[k, low:high].copy()
            first[0] = True
            nodes = low + np.flatnonzero(first)
            parent = np.searchsorted(starts, nodes, "right") - 1
            held = held[parent] + (parts[nodes, k][:, None] - entries[:, k]) ** 2
            starts = nodes
        leaf = np.searchsorted(starts, np.arange(low, high), "right") - 1  # equal rows are one leaf
        nearest = held.argmin(axis=1)
        best[low:high] = nearest[leaf]
        least[low:high] = held[np.arange(len(nearest)), nearest][leaf]
    return best, least


def _tries(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, rows, parts, weights) of a batch, the rows in lexicographic order."""
    position = np.asarray(batch.column(0))
    part = np.asarray(batch.column(1).flatten()).reshape(-1, width)
    weight = np.asarray(batch.column(2))
    order = np.lexsort((*part.T[::-1], position))
    for p in np.unique(position).tolist():
        rows = order[position[order] == p]
        yield p, rows, part[rows], weight[rows]


def _summing(books: Codebooks):
    """Per position and entry: the weighted sum of its parts by dimension, their number as dimension -1."""
    width = len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(books), len(books[0]), width + 1), np.int64)
        for batch in batches:
            for p, _, part, weight in _tries(batch, width):
                best, _ = walk(part, np.array(books[p], np.int64))
                np.add.at(sums[p], best, np.column_stack([part, np.ones_like(weight)]) * weight[:, None])
        p, e = np.nonzero(sums[:, :, width])
        k = np.tile([*range(width), -1], len(p))
        yield pa.record_batch([pa.array(np.repeat(p, width + 1), pa.int32()), pa.array(np.repeat(e, width + 1), pa.int32()),
                               pa.array(k, pa.int32()), pa.array(sums[p, e].ravel())], names=["position", "entry", "dim", "total"])

    return run


def _coding(books: Codebooks):
    width = len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = np.empty(len(batch), np.int32), np.empty(len(batch), np.int64)
            for p, rows, part, _ in _tries(batch, width):
                entry[rows], distance[rows] = walk(part, np.array(books[p], np.int64))
            yield pa.record_batch([*batch.columns, pa.array(entry), pa.array(distance)],
                                  names=["position", "part", "weight", "entry", "distance"])

    return run


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the ``entries`` vectors with the smallest ids."""
    rows = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    width = len(rows[0]["v"]) // parts
    return [[r["v"][p * width:(p + 1) * width] for r in rows] for p in range(parts)]


def _moved(books: Codebooks, distinct: DataFrame) -> Codebooks:
    found = distinct.mapInArrow(_summing(books), "position int, entry int, dim int, total long")
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in found.groupBy("position", "entry", "dim").agg(F.sum("total").alias("total")).collect():
        sums.setdefault((r["position"], r["entry"]), {})[r["dim"]] = r["total"]
    return [[[sums[p, e][k] // sums[p, e][-1] for k in range(len(entry))] if (p, e) in sums else entry
             for e, entry in enumerate(book)] for p, book in enumerate(books)]


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", item: Column | None = None, parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(row, id, item, codes, error) of every usable vector, and the final codebooks.

    ``codes`` lists the entry numbers by part position, ``error`` is the sum of the parts' squared
    distances to them; ``item`` is carried along.
    """
    item = F.lit(None).cast("int") if item is None else item
    vectors = keep(integer_vectors(df, id_col, vec_col, item, scale), "trie-vectors")
    smallest = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(1).select(F.size("v").alias("n")).first()
    dim = smallest["n"] if smallest else parts
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    vectors = vectors.where(F.size("v") == dim)
    width = dim // parts
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("v", p * width + 1, width))
    single = vectors.select("row", "id", "item", F.posexplode(cut).alias("position", "part"))
    counted = single.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))
    # One sorted stretch of the tries per task, written once and walked in every round.
    distinct = keep(counted.repartitionByRange(partitions(df.sparkSession), "position", "part")
                    .sortWithinPartitions("position", "part"), "trie-parts")

    books = first_codebooks(vectors, parts, entries) if smallest else [[[0] * width]] * parts
    for _ in range(rounds if smallest else 0):
        books = _moved(books, distinct)
    coded = keep(distinct.mapInArrow(_coding(books), "position int, part array<long>, weight long, entry int, distance long"),
                 "trie-coded")

    total = vectors.count()
    key, value = ["position", "part"], ["entry", "distance"]
    hot = coded.where(F.col("weight") * HOT > total).select(*key, *value)  # at most HOT rows a position
    looked = single.join(F.broadcast(hot), key, "left")
    rest = looked.where("entry IS NULL").drop(*value).join(coded.where(F.col("weight") * HOT <= total).select(*key, *value), key)
    joined = looked.where("entry IS NOT NULL").unionByName(rest)
    codes = F.transform(F.sort_array(F.collect_list(F.struct("position", "entry"))), lambda c: c["entry"])
    result = joined.groupBy("row").agg(F.first("id").alias("id"), F.first("item").alias("item"), codes.alias("codes"),
                                       F.sum("distance").alias("error"))
    return result, books if smallest else []


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits per entry number."""
    return F.array_join(F.transform(codes, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")


def codebooks_sha256(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


# ---------------------------------------------------------------- query
def op12_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings coded; the error also summed by label."""
    coded, books = compress(table(spark, sf_dir, "embeddings"), item=F.col("label"))
    coded = keep(coded.select(F.col("id").alias("vec_id"), hex_code(F.col("codes")).alias("code"), "error", "item"), "trie-codes")
    by_label = coded.groupBy(F.col("item").alias("label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("item").eqNullSafe(F.col("label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


# Every distance of every part to every entry, round by round. least = distance * 64 + entry.
def _assigned(round_: int) -> str:
    square = " + ".join(f"(x[{k}] - c[{k}]) * (x[{k}] - c[{k}])" for k in range(1, 5))
    mean = ", ".join(f"floor(sum(x[{k}])::DOUBLE / count(*))::BIGINT" for k in range(1, 5))
    return f"""
a{round_} AS (SELECT vec_id, j, any_value(x) AS x, min(({square}) * 64 + e) AS least FROM p JOIN c{round_} USING (j) GROUP BY vec_id, j),
m{round_} AS (SELECT j, least % 64 AS e, [{mean}] AS moved FROM a{round_} GROUP BY j, least % 64),
c{round_ + 1} AS (SELECT j, e, coalesce(moved, c) AS c FROM c{round_} LEFT JOIN m{round_} USING (j, e)),"""


_ORACLE = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT vec_id, j, list_slice(v, 4 * j + 1, 4 * j + 4) AS x FROM v, range(16) r(j)),
c0 AS (SELECT j, e, x AS c FROM (SELECT j, x, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e FROM p) WHERE e < 64),
{_assigned(0)}{_assigned(1)}{_assigned(2)}
o AS (SELECT vec_id, string_agg(lpad(lower(to_hex(least % 64)), 2, '0'), '' ORDER BY j) AS code, sum(least // 64)::BIGINT AS error
      FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, e)) FROM c2) AS codebooks_sha256
FROM o JOIN v USING (vec_id)"""

QUERIES = {"op12_trie_codes": op12_trie_codes}
ORACLE = {"op12_trie_codes": _ORACLE}
