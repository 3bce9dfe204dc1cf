"""Packing documents into fixed-size sequences along a space-filling curve.

A document's token counts are hashed into ``HASHED`` dimensions, damped, normalized and
projected to ``DIMS`` dimensions by a fixed random matrix; the cell of that point gets
its Hilbert key. Documents sorted by key have similar neighbours, and the sequences are
cut from that order without gaps: only the very last sequence is short.

The order is dealt to ranges whose bounds are quantiles of (Hilbert key, hash of doc_id),
so very many copies of one document, which share a Hilbert key, still spread over many
ranges. The tokens before a range are summed per range; inside a range the rows stream.

Defined results: null text is empty, an empty text is its end id alone; a null doc_id is
a document like any other; repeated rows are packed each; other columns are not read; an
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import keep, table
from ._ranges import bounds, in_order, range_of, starts
from ._tokens import encoder, tokenizer_path

CAPACITY = 2048
END_ID = 1
HASHED = 1024
DIMS = 4
BITS = 8
SEED = 20240607


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve positions of integer points (n, dims), ``bits`` per dimension."""
    x = [cells[:, d].astype(np.uint64) for d in range(cells.shape[1])]
    zero = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, 0, -1):  # undo the turns and mirrors of each level, coarse to fine
        low = np.uint64((1 << level) - 1)
        for d in range(len(x)):
            here = (x[d] >> np.uint64(level)) & np.uint64(1) == 1
            swap = np.where(here, zero, (x[0] ^ x[d]) & low)
            x[0] = np.where(here, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = zero
    for level in range(bits - 1, 0, -1):
        flip = flip ^ np.where((x[-1] >> np.uint64(level)) & np.uint64(1) == 1, np.uint64((1 << level) - 1), zero)
    key = zero
    for level in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << np.uint64(1)) | (((x[d] ^ flip) >> np.uint64(level)) & np.uint64(1))
    return key


class Projector:
    """Token ids -> point on the grid."""

    def __init__(self, vocab_size: int):
        rng = np.random.default_rng(SEED)
        self.slot = rng.integers(0, HASHED, vocab_size)
        self.matrix = rng.normal(size=(HASHED, DIMS))

    def point(self, ids: np.ndarray) -> np.ndarray:
        v = np.log1p(np.bincount(self.slot[ids], minlength=HASHED))
        size = np.sqrt(v @ v)
        return v @ self.matrix / (size if size else 1.0)

    @staticmethod
    def cells(points: np.ndarray) -> np.ndarray:
        # Coordinates are about standard normal; the logistic curve spreads them over the grid.
        share = 1.0 / (1.0 + np.exp(-1.7 * np.clip(points, -20, 20)))
        return np.minimum((share * (1 << BITS)).astype(np.uint64), (1 << BITS) - 1)


def _tokenizing(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        project = Projector(max(enc.vocab_size, end_id + 1))
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids_out, n_out, points, salts = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py() or "") + end
                numbers = np.frombuffer(ids, enc.dtype)
                ids_out.append(ids)
                n_out.append(len(numbers))
                points.append(project.point(numbers))
                salts.append(xxhash.xxh3_64_intdigest(str(doc_id)) >> 33)
            if not ids_out:
                continue
            keys = hilbert_keys(project.cells(np.array(points)), BITS)
            curve = (keys << np.uint64(31)) | np.array(salts, np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(curve.view(np.int64)), pa.array(n_out, pa.int64()),
                                   pa.array(ids_out, pa.binary())], names=["doc_id", "curve", "doc_tokens", "ids"])

    return run


def _cutting(path: str, capacity: int, first: dict[int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        here, at = None, 0
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, rng, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if rng != here:
                    here, at = rng, first[rng]
                numbers = np.frombuffer(ids.as_buffer(), dtype).astype("<u4")
                done = 0
                while done < len(numbers):
                    offset = at % capacity
                    n = min(capacity - offset, len(numbers) - done)
                    piece = numbers[done:done + n].tobytes()
                    row = (doc_id, done, n, zlib.crc32(piece), len(numbers), at // capacity, offset, piece if with_ids else None)
                    for k, v in zip(out, row):
                        out[k].append(v)
                    done += n
                    at += n
            yield pa.record_batch([pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()],
                                  names=list(out))

    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (little-endian unsigned 32-bit numbers; null without ``with_ids``).
    """
    pairs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    tokens = keep(pairs.mapInArrow(_tokenizing(path, end_id), "doc_id long, curve long, doc_tokens long, ids binary"),
                  "packing-tokens")
    rng = range_of("curve", bounds(tokens, "curve"))
    first = starts(tokens.select(rng.alias("range"), "doc_tokens"), "range", "doc_tokens")
    ordered = in_order(tokens.withColumn("range", rng), "range", "curve", "doc_id", "doc_tokens").select("doc_id", "range", "ids")
    return ordered.mapInArrow(
        _cutting(path, capacity, first, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (array<int>), lengths of its pieces. A sequence shorter than the
    capacity is padded to it, unless its length is a power of two. At most ``capacity``
    pieces meet in a group.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            ids = [np.concatenate([np.frombuffer(p["ids"], "<u4") for p in r]).astype(np.int32) for r in rows]
            ids = [x if len(x) & (len(x) - 1) == 0 else np.pad(x, (0, max(0, capacity - len(x))), constant_values=pad_id)
                   for x in ids]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                                   pa.array([[p["length"] for p in r] for r in rows], pa.list_(pa.int64()))],
                                  names=["sequence_id", "ids", "lengths"])

    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return grouped.mapInArrow(build, "sequence_id long, ids array<int>, lengths array<long>")


# ---------------------------------------------------------------- query
def op2_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)
    return pieces.drop("ids")


QUERIES = {"op2_hilbert_packing": op2_hilbert_packing}
ORACLE: dict[str, str] = {}
