"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt to blocks. In a block every dimension has a list of its vectors
sorted by component. A query walks the lists of its non-zero dimensions in parallel (from
the large end where its own component is positive, from the small end where negative),
scores each vector when it first meets it, and stops as soon as the bound - the score of
an imaginary vector with the last component met in every list - is below its kth best
score. (At a bound equal to that score an unseen vector could still win a tie.) The
blocks' answers are merged by query.

Blocks of candidates meet blocks of queries, so a task holds at most ``BLOCK`` vectors
and ``QUERY_BLOCK`` queries, however large the table.

Defined results: vectors that are null, empty or hold null or non-finite components take
no part, nor do rows with a null id; vectors of different lengths do not meet; equal rows
count once; a query never meets a row of its own id; ties go to the smaller id; other
columns are not read. Components are taken as integers and scores are exact up to the
range of a long.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import keep, table

K = 20
SCALE = 64
BLOCK = 8192
QUERY_BLOCK = 1024
#: Depth of the first look at the bound, and how much deeper each next one is.
FIRST_DEPTH = 32
DEEPER = 8


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the usable rows, equal rows once."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = F.col(f"`{id_col}`").isNotNull() & (F.size(x) > 0) & F.forall(x, finite)
    return (df.where(usable).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                                    F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v")).distinct())


class SortedLists:
    """The per-dimension lists of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def top(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, best first, smaller id first among ties."""
        n = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        rows, scores = np.empty(0, int), np.empty(0, q.dtype)
        depth = FIRST_DEPTH
        while True:
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            if depth == n or not len(up) + len(down):
                fresh[:] = True  # every list is walked to its end
                depth = n
            else:
                fresh[self.order[n - depth:, up]] = True
                fresh[self.order[:depth, down]] = True
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            new = new[self.ids[new] != query_id]
            rows = np.concatenate([rows, new])
            scored = (self.vectors @ q)[new] if 4 * len(new) > n else self.vectors[new] @ q
            scores = np.concatenate([scores, scored])
            if len(scores) > k:
                floor = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= floor  # ties at the kth score stay
                rows, scores = rows[near], scores[near]
            if depth == n:
                break
            if len(scores) >= k:
                bound = self.sorted[n - depth, up] @ q[up] + self.sorted[depth - 1, down] @ q[down]
                if bound < scores.min():
                    break
            # Where most of the block is seen already, scoring the rest is cheaper than walking on.
            depth = n if 2 * int(seen.sum()) > n else depth * DEEPER
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten()).reshape(len(flat), dim)


def _cell(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and queries.num_rows:
            dim = candidates["dim"][0].as_py()
            ids = np.asarray(candidates["vec_id"].combine_chunks())
            v, q = _matrix(candidates["v"], dim), _matrix(queries["v"], dim)
            # Doubles are exact while no sum can pass 2^53; else longs (slower, exact to their range).
            if float(np.abs(v).max()) * float(np.abs(q).max()) * dim < 2.0**53:
                v, q = v.astype(np.float64), q.astype(np.float64)
            lists = SortedLists(ids, v)
            for query_id, row in zip(queries["vec_id"].to_pylist(), q):
                rows, scores = lists.top(query_id, row, k)
                out["query_id"].append(np.full(len(rows), query_id, np.int64))
                out["vec_id"].append(lists.ids[rows])
                out["score"].append(scores.astype(np.int64))
        return pa.table({c: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for c, v in out.items()})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, v) that ``is_query`` selects."""
    vectors = keep(vectors.withColumn("dim", F.size("v")), "topk-vectors")
    queries = vectors.where(is_query)
    n_blocks = max(1, -(-vectors.count() // block))
    n_query_blocks = max(1, -(-queries.count() // query_block))

    def cells(df: DataFrame, own: int, other: int, own_name: str, other_name: str) -> DataFrame:
        return (df.withColumn(own_name, F.pmod(F.xxhash64("vec_id"), F.lit(own)))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0), F.lit(other - 1)).cast("array<long>")))
                .repartition(n_blocks * n_query_blocks, "dim", "block", "query_block"))

    left = cells(vectors, n_blocks, n_query_blocks, "block", "query_block")
    right = cells(queries, n_query_blocks, n_blocks, "query_block", "block")
    key = ["dim", "block", "query_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# ---------------------------------------------------------------- query
def op6_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 20 == 0)


_ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""

QUERIES = {"op6_threshold_top_k": op6_threshold_top_k}
ORACLE = {"op6_threshold_top_k": _ORACLE}
