"""Near-duplicates by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so half the hash evaluations of MinHash fill the same signature. Rows of
consecutive values are hashed into bands; texts that share a band are candidates, and a
candidate counts as a link only after the full shingle sets were compared.

The candidate search emits no all-pairs lists. Exact copies are one node. Inside the
buckets every node is first compared with one leader (the bucket minimum it meets in most
bands). Then, with the components so found, only nodes outside their bucket's largest
component are held against the bucket's nodes of other components. In groups whose
members are just too different to link, these would be nearly all pairs; so a pair is
made only if its shingle sets can reach the similarity at all. Two upper bounds of the
intersection decide that, both exact: shingles that no other open node has can't be
shared, and the rest are hashed into a bitmap of ``SKETCH_WORDS`` * 64 slots, where an
intersection has at most the common slots plus the smaller set's collisions. Every
candidate pair is thus compared, connected already, or proven too different.

With ``ROWS`` values a band and ``BANDS`` bands a pair of similarity s is no candidate
with probability (1 - s^ROWS)^BANDS, and (as two shared bands are asked for after the
first round) at most about 2e-9 at 0.85 and 3e-6 at 0.8.

Defined results: null text, empty text and text without words have an empty shingle set,
link with nothing and are their own component; fewer words than a shingle: the whole
sequence is one shingle. A row with a null id takes no part (component null, kept). Ids
should be unique: different texts under one id are taken as linked, and rows repeated
under one id are all kept or dropped with it. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import keep, table
from ._graph import components

ROWS = 5
BANDS = 40
SEED = 20240607
MIN_SHARED_BANDS = 2
#: Long words of the bitmap that bounds intersections.
SKETCH_WORDS = 32
#: Word hashes kept by a Python worker; the table is emptied when it is full.
MAX_CACHED_WORDS = 400_000
_CHUNK = 4096


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(text: str | None) -> list[bytes]:
    # On bytes, lower() changes A-Z alone and split() cuts at \x20 and \x09-\x0D alone.
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (the whole sequence if shorter)."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - k + 1, 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, len(words))):
        out = _mix(out + h[j:j + n] + np.uint64(j + 1))
    if len(words) < k:
        out = _mix(out + np.uint64(len(words)))
    return np.unique(out)


class Signer:
    """Min-max signatures cut into bands."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS):
        self.rows, self.bands = rows, bands
        n = (rows * bands + 1) // 2
        rng = np.random.default_rng(SEED)
        self.mul = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, n, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """min, max of permutation 0, min, max of permutation 1, ..."""
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.mul), np.uint64)
        for i in range(0, len(shingles), _CHUNK):
            x = shingles[i:i + _CHUNK, None] * self.mul + self.add
            np.minimum(low, x.min(axis=0), out=low)
            np.maximum(high, x.max(axis=0), out=high)
        return np.column_stack([low, high]).ravel()[: self.rows * self.bands]

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for j in range(self.rows):
            key = _mix(key + parts[:, j])
        return key.view(np.int64)


def _signing(shingle: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(rows, bands)
        for batch in batches:
            ids, d1, d2, sizes, keys = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = _words(text.as_py())
                shingles = shingle_set(words, shingle)
                digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), ">i8")
                ids.append(doc_id)
                d1.append(int(digest[0]))
                d2.append(int(digest[1]))
                sizes.append(len(shingles))
                keys.append(signer.band_keys(signer.signature(shingles)) if len(shingles) else None)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                                   pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                  names=["doc_id", "d1", "d2", "n_shingles", "bands"])

    return run


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, rows: int = ROWS,
               bands: int = BANDS) -> DataFrame:
    """doc_id, d1, d2 (digest of the word sequence), n_shingles, bands; one map-only pass."""
    pairs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return pairs.mapInArrow(_signing(shingle, rows, bands),
                            "doc_id long, d1 long, d2 long, n_shingles long, bands array<long>")


def _shingling(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(_words(t.as_py()), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, shared shingles -> node, their number, slot collisions, bitmap words."""
    slots = SKETCH_WORDS * 64
    for batch in batches:
        size, lost, maps = [], [], []
        for shared in batch.column(1):
            h = np.asarray(shared.values).view(np.uint64) if len(shared) else np.empty(0, np.uint64)
            taken = np.zeros(slots, bool)
            taken[(_mix(h) % np.uint64(slots)).astype(np.int64)] = True
            size.append(len(h))
            lost.append(len(h) - int(taken.sum()))
            maps.append(np.packbits(taken).view(np.int64))
        words = np.array(maps, np.int64).reshape(len(maps), SKETCH_WORDS)
        yield pa.record_batch([batch.column(0), pa.array(size, pa.int64()), pa.array(lost, pa.int64()),
                               *[pa.array(words[:, k]) for k in range(SKETCH_WORDS)]],
                              names=["node", "core", "lost", *[f"w{k}" for k in range(SKETCH_WORDS)]])


def _sketches(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node: how many of its shingles some other of the ``nodes`` has, and their bitmap."""
    own = sets.join(nodes, "node", "left_semi")
    lone = (own.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
            .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
            .groupBy("node").agg(F.collect_list("shingle").alias("lone")))
    core = F.when(F.col("lone").isNull(), F.col("shingles")).otherwise(F.array_except("shingles", "lone"))
    schema = "node long, core long, lost long, " + ", ".join(f"w{k} long" for k in range(SKETCH_WORDS))
    return own.join(lone, "node", "left").select("node", core.alias("core")).mapInArrow(_sketching, schema)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. AQE splits a node with many pairs."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.select("a", "b").join(right, "b").join(left, "a").where(both * 100 >= union * percent).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two rows are linked if their shingle sets' Jaccard similarity is ``percent`` or more;
    a component is kept by its smallest id.
    """
    signed = keep(signatures(docs, id_col, text_col, shingle, rows, bands), "minmax-signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # One node per word sequence: its smallest id. Equal sequences have equal bands.
    node = usable.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("x"))
    nodes = keep(node.select("d1", "d2", F.col("x.doc_id").alias("node"), F.col("x.n_shingles").alias("n"),
                             F.col("x.bands").alias("bands")), "minmax-nodes")
    in_band = nodes.select("node", "n", F.explode("bands").alias("band"))
    buckets = keep(in_band.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
                   .where("leader <> last").select("band", "leader"), "minmax-buckets")
    members = keep(in_band.join(buckets, "band"), "minmax-members")

    involved = members.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sets = keep(texts.join(involved, "doc_id", "left_semi").mapInArrow(_shingling(shingle), "node long, shingles array<long>"),
                "minmax-sets")

    met = members.where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("times"))
    parent = met.groupBy("node").agg(F.max(F.struct("times", (-F.col("leader")).alias("neg"))).alias("x"))
    first = keep(_linked(parent.select((-F.col("x.neg")).alias("a"), F.col("node").alias("b")), sets, percent), "minmax-first")

    grouped = keep(members.join(components(first, "minmax-c1"), "node", "left")
                   .select("band", "node", "n", F.coalesce("component", "node").alias("c")), "minmax-grouped")
    sizes = grouped.groupBy("band", "c").agg(F.count(F.lit(1)).alias("size"))
    mixed = keep(sizes.groupBy("band").agg(F.max(F.struct("size", (-F.col("c")).alias("neg"))).alias("x"),
                                           F.count(F.lit(1)).alias("parts"))
                 .where("parts > 1").select("band", (-F.col("x.neg")).alias("main")), "minmax-mixed")
    open_rows = keep(grouped.join(mixed, "band"), "minmax-open")
    sketches = keep(_sketches(sets, open_rows.select("node").distinct()), "minmax-sketches")
    x = keep(open_rows.join(sketches, "node"), "minmax-held")
    y = x.where("c <> main").select("band", *[F.col(c).alias(f"o_{c}") for c in x.columns if c not in ("band", "main")])
    bits = sum(F.bit_count(F.col(f"w{k}").bitwiseAND(F.col(f"o_w{k}"))) for k in range(SKETCH_WORDS))
    total = (F.col("n") + F.col("o_n")) * percent
    reaches = lambda shared: shared * (100 + percent) >= total  # noqa: E731  100 * shared >= percent * union
    pairs = (
        x.join(y, "band")
        .where((F.col("c") != F.col("o_c")) & ((F.col("c") == F.col("main")) | (F.col("o_node") < F.col("node")))
               & reaches(F.least("core", "o_core")) & reaches(bits + F.least("lost", "o_lost")))
        .groupBy(F.least("o_node", "node").alias("a"), F.greatest("o_node", "node").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= MIN_SHARED_BANDS)
    )
    second = _linked(pairs, sets, percent)

    found = components(first.unionByName(second), "minmax-c2")
    by_text = keep(nodes.select("d1", "d2", "node").join(found, "node", "left")
                   .select("d1", "d2", F.coalesce("component", "node").alias("component")), "minmax-classes")
    component = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "d1", "d2").join(by_text, ["d1", "d2"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


# ---------------------------------------------------------------- query
def op10_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


_ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, least(len(ws), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * shared >= 85 * (u.n + v.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, k.c AS component_id, d.doc_id = k.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) k USING (doc_id)"""

QUERIES = {"op10_minmax_near_dedup": op10_minmax_near_dedup}
ORACLE = {"op10_minmax_near_dedup": _ORACLE}
