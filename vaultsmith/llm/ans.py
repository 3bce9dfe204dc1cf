"""Token files coded by a static range asymmetric numeral system (rANS).

One frequency table, counted over all tokens, is shared by all blocks. A block holds whole
documents and is coded alone: token i belongs to lane i mod ``LANES``, every lane has its
own state, and all lanes of a step are coded at once. Each ``CHECK_STEPS`` steps the lane
states and the place in the word stream are recorded, so a block can be decoded from any
checkpoint, several parts in parallel. A block ends with the checksum of all before it.

Files (all written and read by Spark, so any storage it knows will do; its commit
protocol makes a lost task harmless):

* ``table``: token, count, frequency. Frequencies add up to ``1 << SCALE_BITS``.
* ``blocks``: block_start (tokens before the block), n_tokens, frame. A frame is, little
  endian: magic ``rANS``, numbers of tokens, documents, lanes, checkpoints and words
  (5 x u32); document ids (i64), 1 for each null id (u8), document lengths (u32); per
  checkpoint step and word position (2 x u32), then lane states (u64); words (u32);
  CRC-32 (u32).

Defined results: null text is empty, an empty text is its end id alone; documents are in
ascending order of doc_id, null ids first, repeated rows each on its own; other columns
are not read; an empty table gives files without blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import keep, shared_path, table
from ._ranges import bounds, in_order, range_of, starts
from ._tokens import encoder, tokenizer_path

SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 17
CHECK_STEPS = 32
END_ID = 2
_MAGIC = b"rANS"
_LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63); words have 32 bits
_32 = np.uint64(32)


# ------------------------------------------------------------- frequency table
def frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to add up to ``1 << bits``, at least 1 for every token that occurs."""
    total, size = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > size:
        raise ValueError("more distinct tokens than the table can tell apart")
    f = np.where(counts > 0, np.maximum(1, counts.astype(object) * size // total), 0).astype(np.int64)
    over = int(f.sum()) - size
    if over <= 0:
        f[np.argmax(f)] -= over
        return f
    for i in np.argsort(-f, kind="stable"):  # take what the raised ones got from the largest
        cut = min(int(f[i]) - 1, -(-over * int(f[i]) // size) + 1, over)
        f[i] -= cut
        over -= cut
        if not over:
            break
    while over:
        i = int(np.argmax(f))
        cut = min(int(f[i]) - 1, over)
        f[i] -= cut
        over -= cut
    return f


class Coder:
    """Codes blocks by one table."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self._slots: np.ndarray | None = None

    def encode(self, tokens: np.ndarray, lanes: int) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
        """(checkpoints as (step, word position, states), words); steps run from the last to the first."""
        steps = -(-len(tokens) // lanes)
        x = np.full(lanes, _LOW, np.uint64)
        parts, marks, emitted = [], [], 0
        for s in range(steps - 1, -1, -1):
            t = tokens[s * lanes:(s + 1) * lanes]
            y = x[:len(t)]
            f = self.freq[t]
            full = y >= self.limit[t]
            words = (y[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            parts.append(words)
            emitted += len(words)
            y = np.where(full, y >> _32, y)
            q = y // f
            x[:len(t)] = (q << self.bits) + (y - q * f) + self.start[t]
            if s % CHECK_STEPS == 0:
                marks.append((s, emitted, x.copy()))
        words = np.concatenate(parts[::-1]) if parts else np.empty(0, "<u4")
        return [(s, len(words) - e, states) for s, e, states in marks[::-1]], words

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def decode(self, n_tokens: int, lanes: int, words: np.ndarray, mark: tuple[int, int, np.ndarray],
               until: int | None = None) -> np.ndarray:
        """Tokens from a checkpoint up to step ``until`` (the end by default)."""
        step, at, states = mark
        last = -(-n_tokens // lanes) if until is None else until
        x = states.astype(np.uint64)
        mask = np.uint64((1 << int(self.bits)) - 1)
        out = np.empty(max(min(n_tokens, last * lanes) - step * lanes, 0), np.uint32)
        for s in range(step, last):
            k = min(lanes, n_tokens - s * lanes)
            y = x[:k]
            slot = y & mask
            t = self.slots[slot.astype(np.int64)]
            out[(s - step) * lanes:(s - step) * lanes + k] = t
            y = self.freq[t] * (y >> self.bits) + slot - self.start[t]
            low = np.flatnonzero(y < _LOW)
            y[low] = (y[low] << _32) | words[at:at + len(low)].astype(np.uint64)
            at += len(low)
            x[:k] = y
        return out


def write_frame(coder: Coder, ids: list[int | None], docs: list[np.ndarray], lanes: int = LANES) -> bytes:
    tokens = np.concatenate(docs) if docs else np.empty(0, np.int64)
    marks, words = coder.encode(tokens, lanes)
    head = _MAGIC + struct.pack("<5I", len(tokens), len(docs), lanes, len(marks), len(words))
    body = [head, np.array([i or 0 for i in ids], "<i8").tobytes(), bytes([i is None for i in ids]),
            np.array([len(d) for d in docs], "<u4").tobytes()]
    for step, at, states in marks:
        body += [struct.pack("<2I", step, at), states.astype("<u8").tobytes()]
    frame = b"".join([*body, words.tobytes()])
    return frame + struct.pack("<I", zlib.crc32(frame))


class Frame:
    """A frame, checked and taken apart."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged token block: its checksum does not hold")
        self.n_tokens, n_docs, self.lanes, n_marks, n_words = struct.unpack_from("<5I", data, 4)
        at = 24
        ids = np.frombuffer(data, "<i8", n_docs, at).tolist()
        nulls = data[at + 8 * n_docs:at + 9 * n_docs]
        self.ids = [None if z else i for i, z in zip(ids, nulls)]
        at += 9 * n_docs
        self.lengths = np.frombuffer(data, "<u4", n_docs, at).astype(np.int64)
        at += 4 * n_docs
        self.marks = []
        for _ in range(n_marks):
            step, place = struct.unpack_from("<2I", data, at)
            self.marks.append((step, place, np.frombuffer(data, "<u8", self.lanes, at + 8)))
            at += 8 + 8 * self.lanes
        self.words = np.frombuffer(data, "<u4", n_words, at)

    def part(self, coder: Coder, k: int) -> np.ndarray:
        """The tokens between checkpoint ``k`` and the next: parts can be decoded in any order."""
        until = self.marks[k + 1][0] if k + 1 < len(self.marks) else None
        return coder.decode(self.n_tokens, self.lanes, self.words, self.marks[k], until)

    def tokens(self, coder: Coder) -> np.ndarray:
        return coder.decode(self.n_tokens, self.lanes, self.words, self.marks[0]) if self.marks else np.empty(0, np.uint32)


# ------------------------------------------------------------- Spark side
def _tokenizing(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids = [enc.encode(t.as_py() or "") + end for t in batch.column(1)]
            n = [len(x) // enc.dtype.itemsize for x in ids]
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                                  names=["doc_id", "n_tokens", "ids"])

    return run


def _counting(dtype: np.dtype, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            # All ids of a batch lie side by side.
            ids = batch.column(0)
            ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            held = ids.buffers()[2]
            if len(ids) and held is not None:
                counts += np.bincount(np.frombuffer(held, dtype, (int(ends[-1]) - int(ends[0])) // dtype.itemsize, int(ends[0])), minlength=size)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], names=["token", "count"])

    return run


def _encoding(freq: np.ndarray, dtype: np.dtype, first: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        here, at, ids, docs, size = None, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array([at], pa.int64()), pa.array([size], pa.int64()),
                                    pa.array([write_frame(coder, ids, docs)], pa.binary())],
                                   names=["block_start", "n_tokens", "frame"])

        for batch in batches:
            for doc_id, rng, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if docs and (rng != here or size >= BLOCK_TOKENS):
                    yield flush()
                    at, ids, docs, size = at + size, [], [], 0
                if rng != here:
                    here, at = rng, first[rng]
                tokens = np.frombuffer(data.as_buffer(), dtype).astype(np.int64)
                ids.append(doc_id)
                docs.append(tokens)
                size += len(tokens)
        if docs:
            yield flush()

    return run


def _decoding(freq: np.ndarray, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for begin, frame in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Frame(frame.as_py())
                tokens = block.tokens(coder).astype("<u4")
                ends = np.cumsum(block.lengths)
                data = [tokens[e - n:e].tobytes() for e, n in zip(ends, block.lengths)]
                last = pa.array([zlib.crc32(d) for d in data], pa.int64()) if digest else pa.array(data, pa.binary())
                yield pa.record_batch([pa.array(block.ids, pa.int64()), pa.array(begin + ends - block.lengths, pa.int64()),
                                       pa.array(block.lengths, pa.int64()), last],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write ``folder/table`` and ``folder/blocks``."""
    spark = docs.sparkSession
    enc = encoder(tokenizer)
    size = max(enc.vocab_size, end_id + 1)
    pairs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    tokens = keep(pairs.mapInArrow(_tokenizing(tokenizer, end_id), "doc_id long, n_tokens long, ids binary"),
                  "ans-tokens", "zstd")
    counted = (tokens.select("ids").mapInArrow(_counting(enc.dtype, size), "token long, count long")
               .groupBy("token").agg(F.sum("count").alias("count")).collect())  # at most one row per token of the vocabulary
    counts = np.zeros(size, np.int64)
    for r in counted:
        counts[r["token"]] = r["count"]
    freq = frequencies(counts)
    rows = [(int(t), int(counts[t]), int(freq[t])) for t in np.flatnonzero(counts)]
    spark.createDataFrame(rows, "token long, count long, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    rng = range_of("doc_id", bounds(tokens, "doc_id"))
    first = starts(tokens.select(rng.alias("range"), "n_tokens"), "range", "n_tokens")
    ordered = in_order(tokens.withColumn("range", rng), "range", "doc_id", "n_tokens").select("doc_id", "range", "ids")
    blocks = ordered.mapInArrow(_encoding(freq, enc.dtype, first), "block_start long, n_tokens long, frame binary")
    blocks.write.parquet(f"{folder}/blocks", compression="uncompressed")


def read_token_files(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) or, with ``digest``, ids_crc32."""
    stored = spark.read.parquet(f"{folder}/table").collect()
    freq = np.zeros(max([r["token"] for r in stored], default=-1) + 1, np.int64)
    for r in stored:
        freq[r["token"]] = r["frequency"]
    blocks = spark.read.schema("block_start long, n_tokens long, frame binary").parquet(f"{folder}/blocks")
    last = "ids_crc32 long" if digest else "ids binary"
    return blocks.select("block_start", "frame").mapInArrow(_decoding(freq, digest), f"doc_id long, start long, n_tokens long, {last}")


# ---------------------------------------------------------------- query
def op4_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "ans-files")
    write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), folder)
    return read_token_files(spark, folder, digest=True)


QUERIES = {"op4_rans_token_files": op4_rans_token_files}
ORACLE: dict[str, str] = {}
