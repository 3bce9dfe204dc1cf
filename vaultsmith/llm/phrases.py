"""Benchmark decontamination with a distributed positional inverted index.

Every task cuts the documents it reads into shards of at most ``SHARD_WORDS`` words (a
longer document is a shard of its own) and writes for each word of a shard its postings:
the positions, ascending, as gaps in variable-byte code. Positions count words through the
shard, with one position free behind every document, so no phrase runs over a document's
end. One more row, of the empty word, holds the shard's directory: where each document
starts, its id and its number of words. The index does not depend on any benchmark.

A search brings the postings of the items' words together by shard and block of items. For
every window of an item the list of its rarest word there, moved back by the word's place in
the window, gives the candidate starts; the lists of the other words, from the rarest to
the most frequent, are intersected with them, each moved by its own place. As a position
is on exactly one list, a table from position to list answers the membership of all lists. The
windows whose words lie within ``window + slop`` words in any order are found from the
rarest word's list as well, by counting the other words' positions around each of its own.

Shards and blocks are bounded, so is a task; a frequent word has one row per shard. Words of more
than ``LONG_WORD`` bytes stand in the index by their SHA-256. Other columns are not read.

Defined results: null or empty texts and texts without words have no positions, take no
part and still have their row in ``documents``; every row of a table is a document of its own,
also with a null or repeated id; an item of fewer words than a window is one window; items
without words match nothing; items without id match, but count as no item in op11's columns; equal
items all match; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import keep, partitions, table

WINDOW = 10
SHARD_WORDS = 1 << 22
SHARD_DOCS = 1 << 18
LONG_WORD = 64
#: Windows per piece of a long item, and about as many windows per block of pieces.
PIECE_WINDOWS = 4096
BLOCK_WINDOWS = 65_536
#: Distinct (block, word) rows that may be broadcast: at most LONG_WORD bytes and two numbers each.
MAX_BROADCAST_WORDS = 200_000
#: Rows with the pieces of a block (see BLOCK_WINDOWS) that may be broadcast.
MAX_BROADCAST_BLOCKS = 16

# Words are runs of digits, letters and anything that isn't ASCII; A-Z count as a-z.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INDEX = "shard long, word binary, n long, gaps binary, starts array<int>, lengths array<int>, ids array<long>"
_FOUND = "shard long, row int, item string, kind string, start int, end int"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


def term(word: bytes) -> bytes:
    """What stands for a word in the index: no word holds a zero byte."""
    return word if len(word) <= LONG_WORD else b"\0" + hashlib.sha256(word).digest()


# ------------------------------------------------------- postings as bytes
def gap_bytes(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-byte code of the numbers (below 2^35), and how many bytes each takes."""
    size = np.ones(len(gaps), np.int64)
    for bits in (7, 14, 21, 28):
        size += gaps >= 1 << bits
    first = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[first[has] + k] = (gaps[has] >> (7 * k)) & 127 | np.where(size[has] > k + 1, 128, 0)
    return out, size


def gaps_of(code: np.ndarray) -> np.ndarray:
    """The numbers of ``gap_bytes``."""
    last = np.flatnonzero(code < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = (code[first] & 127).astype(np.int64)
    longest = int((last - first).max(initial=0))
    for k in range(1, longest + 1):
        more = first + k <= last
        out[more] += (code[first[more] + k].astype(np.int64) & 127) << (7 * k)
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    """Words of some documents, until they are written as postings."""

    def __init__(self):
        self.numbers, self.texts = _Numbers(), []
        self.starts, self.lengths, self.ids = [], [], []
        self.end = 0

    def add(self, doc_id: int | None, ws: list[bytes]) -> None:
        self.starts.append(self.end)
        self.lengths.append(len(ws))
        self.ids.append(doc_id)
        if ws:
            self.texts.append(np.fromiter(map(self.numbers.__getitem__, ws), np.int32, len(ws)))
            self.end += len(ws) + 1

    def rows(self, shard: int) -> pa.RecordBatch:
        n_terms = len(self.numbers)
        count = np.zeros(0, np.int64)
        code, cuts = np.empty(0, np.uint8), np.zeros(1, np.int64)
        if n_terms:
            number = np.concatenate(self.texts)
            sizes = np.array([len(t) for t in self.texts])
            place = np.arange(len(number)) + np.repeat(np.arange(len(sizes)), sizes)  # a free place behind each text
            order = np.argsort((number & 0xFFFF).astype(np.uint16), kind="stable")
            if n_terms > 1 << 16:
                order = order[np.argsort((number[order] >> 16).astype(np.uint16), kind="stable")]
            place = place[order]
            count = np.bincount(number, minlength=n_terms)
            first = np.cumsum(count) - count
            gaps = np.diff(place, prepend=0)
            gaps[first] = place[first]
            code, size = gap_bytes(gaps)
            cuts = np.concatenate([[0], np.cumsum(np.add.reduceat(size, first))])
        none = np.zeros(n_terms, np.int32)
        directory = pa.array([self.starts] + [None] * n_terms, pa.list_(pa.int32()))
        return pa.record_batch([
            pa.array(np.full(n_terms + 1, shard)),
            pa.array([b"", *map(term, self.numbers)], pa.binary()),
            pa.array(np.concatenate([[len(self.starts)], count]).astype(np.int64)),
            pa.Array.from_buffers(pa.binary(), n_terms + 1, [None, pa.py_buffer(np.concatenate([[0], cuts]).astype(np.int32)),
                                                             pa.py_buffer(code)]),
            directory,
            pa.array([self.lengths] + [None] * len(none), pa.list_(pa.int32())),
            pa.array([self.ids] + [None] * len(none), pa.list_(pa.int64())),
        ], names=["shard", "word", "n", "gaps", "starts", "lengths", "ids"])


def _indexing(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A retried task reads the same rows, so it numbers its shards alike.
        number = TaskContext.get().partitionId() << 32
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ws = words(text.as_py())
                if shard.ids and (shard.end + len(ws) > shard_words or len(shard.ids) >= SHARD_DOCS):
                    yield shard.rows(number)
                    number, shard = number + 1, _Shard()
                shard.add(doc_id, ws)
        if shard.ids:
            yield shard.rows(number)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored positional index of all texts: (shard, word, n, gaps) and the directory rows."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return keep(texts.mapInArrow(_indexing(shard_words), _INDEX), "phrase-index", "zstd")


def documents(index: DataFrame) -> DataFrame:
    """(shard, row, doc_id, n_words) of every indexed document."""
    listed = F.posexplode(F.arrays_zip("ids", "lengths")).alias("row", "d")
    return index.where("word = x''").select("shard", listed).select(
        "shard", "row", F.col("d.ids").alias("doc_id"), F.col("d.lengths").cast("long").alias("n_words"))


# ------------------------------------------------------- items
def _cutting(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, pieces, counts = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ws = [term(w) for w in words(text.as_py())]
                for at in range(0, max(len(ws) - window, 0) + 1 if ws else 0, PIECE_WINDOWS):
                    piece = ws[at:at + PIECE_WINDOWS + window - 1]
                    items.append(item)
                    pieces.append(piece)
                    counts.append(max(len(piece) - window, 0) + 1)
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(pieces, pa.list_(pa.binary())),
                                   pa.array(counts, pa.int64())], names=["item", "words", "windows"])

    return run


def pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words, windows): items cut so that each window lies in exactly one piece."""
    texts = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return texts.mapInArrow(_cutting(window), "item string, words array<binary>, windows long")


# ------------------------------------------------------- search in one shard
class Lists:
    """The postings that a shard has of some words."""

    def __init__(self, names: list[bytes], counts: np.ndarray, code: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.number = {w: k for k, w in enumerate(names)}
        self.counts, self.starts = counts, starts
        self.first = np.cumsum(counts) - counts
        gaps = gaps_of(code)
        run = np.cumsum(gaps)
        begin = self.first[counts > 0]
        base = np.repeat(run[begin] - gaps[begin], counts[counts > 0])
        self.places = run - base
        end = int((starts + lengths).max(initial=0)) + 1
        self.list_at = np.full(end + 1, -1, np.int32)
        self.list_at[self.places] = np.repeat(np.arange(len(names), dtype=np.int32), counts)

    def of(self, number: int) -> np.ndarray:
        at = self.first[number]
        return self.places[at:at + self.counts[number]]

    def phrase(self, window: np.ndarray) -> np.ndarray:
        """Starts of the window: offset-adjusted lists, intersected from the rarest word on."""
        rarest, *others = np.argsort(self.counts[window], kind="stable").tolist()
        found = self.of(window[rarest]) - rarest
        found = found[(found >= 0) & (found + len(window) < len(self.list_at))]
        for k in others:
            if not len(found):
                break
            found = found[self.list_at[found + k] == window[k]]
        return found

    def near(self, window: np.ndarray, reach: int) -> list[tuple[int, int]]:
        """The shortest stretches of at most ``reach`` words that hold all the window's words, as
        often as it has them, in any order: (start, end), none inside another."""
        need = Counter(window.tolist())
        rarest, *others = sorted(need, key=lambda t: (self.counts[t], t))
        at = self.of(rarest)
        for t in others:
            at = at[np.searchsorted(self.of(t), at + reach) - np.searchsorted(self.of(t), at - reach + 1) >= need[t]]
        found = set()
        for p in at.tolist():
            around = []
            for t in need:
                own = self.of(t)
                lo, hi = np.searchsorted(own, (p - reach + 1, p + reach))
                around += [(q, t) for q in own[lo:hi].tolist()]
            around.sort()
            held, missing, left = Counter(), len(window), 0
            for q, t in around:
                held[t] += 1
                missing -= held[t] <= need[t]
                while not missing:
                    begin, first = around[left]
                    same = np.searchsorted(self.starts, begin, "right") == np.searchsorted(self.starts, q, "right")
                    if held[first] == need[first]:
                        if q - begin < reach and same:
                            found.add((begin, q + 1))
                        missing += 1
                    held[first] -= 1
                    left += 1
        return sorted(s for s in found if not any(o != s and s[0] <= o[0] and o[1] <= s[1] for o in found))


def _merged(item: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of an item as one."""
    order = np.lexsort((start, item))
    item, start, end = item[order], start[order], end[order]
    shift = item * (int(end.max(initial=0)) + 2)  # sets the items apart on one line
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(item), bool)
    new[1:] = (start + shift)[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(item) - 1) if len(item) else np.empty(0, int)
    return item[new], start[new], reach[last] - shift[last]


def _searching(window: int, slop: int | None):
    def run(cell: pa.Table) -> pa.Table:
        is_directory = np.asarray(cell["starts"].is_valid().combine_chunks())
        lists_at = np.flatnonzero(~is_directory)
        shard = cell["shard"][0].as_py()
        out = {c: [] for c in ("row", "item", "kind", "start", "end")}
        if len(lists_at) and is_directory.any():
            head = int(np.flatnonzero(is_directory)[0])
            starts = np.array(cell["starts"][head].as_py(), np.int64)
            lengths = np.array(cell["lengths"][head].as_py(), np.int64)
            postings = cell.take(pa.array(lists_at))
            code = np.frombuffer(b"".join(postings["gaps"].to_pylist()), np.uint8)
            # Texts without words share their start with the text behind them: look up among the others.
            full = np.flatnonzero(lengths > 0)
            lists = Lists(postings["word"].to_pylist(), np.asarray(postings["n"].combine_chunks()), code, starts[full], lengths[full])
            asked = cell["pieces"][head].as_py()
            known: dict[bytes, np.ndarray] = {}
            for kind in ("phrase", "near"):
                if kind == "near" and slop is None:
                    continue
                which, begins, ends = [], [], []
                for k, piece in enumerate(asked):
                    ws = np.array([lists.number.get(w, -1) for w in piece["words"]], np.int64)
                    m = min(window, len(ws))
                    present = np.convolve(ws >= 0, np.ones(m, int), "valid") == m
                    for at in np.flatnonzero(present).tolist():
                        part = ws[at:at + m]
                        if kind == "phrase":
                            key = part.tobytes()
                            if key not in known:
                                known[key] = lists.phrase(part)
                            s = known[key]
                            e = s + m
                        else:
                            exact = known[part.tobytes()].tolist()
                            spans = [x for x in lists.near(part, m + slop) if x[1] - x[0] > m or x[0] not in exact]
                            s, e = (np.array([x[j] for x in spans], np.int64) for j in (0, 1))
                        if len(s):
                            which.append(np.full(len(s), k))
                            begins.append(s)
                            ends.append(e)
                if which:
                    k, s, e = _merged(np.concatenate(which), np.concatenate(begins), np.concatenate(ends))
                    text = np.searchsorted(lists.starts, s, "right") - 1
                    base = lists.starts[text]
                    out["row"] += full[text].tolist()
                    out["item"] += [asked[j]["item"] for j in k.tolist()]
                    out["kind"] += [kind] * len(k)
                    out["start"] += (s - base).tolist()
                    out["end"] += (e - base).tolist()
        return pa.table({
            "shard": pa.array([shard] * len(out["row"]), pa.int64()), "row": pa.array(out["row"], pa.int32()),
            "item": pa.array(out["item"], pa.string()), "kind": pa.array(out["kind"], pa.string()),
            "start": pa.array(out["start"], pa.int32()), "end": pa.array(out["end"], pa.int32())})

    return run


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
           slop: int | None = None, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(shard, row, item, kind, start, end): where windows of ``window`` consecutive item words occur.

    kind 'phrase': the words of a document from ``start`` to before ``end`` are covered by exact
    occurrences of the item's windows, each overlapping or touching the next. With ``slop`` also
    kind 'near': covered by stretches of at most ``window + slop`` words that hold all of a window's words
    in any order and are no exact occurrence. An item cut into pieces may have its spans cut there, and
    equal rows if its pieces repeat.
    """
    cut = keep(pieces(items, id_col, text_col, window), "phrase-pieces")
    n_blocks = max(1, -(-(cut.agg(F.sum("windows").alias("n")).first()["n"] or 0) // block_windows))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(n_blocks)))
    blocks = keep(cut.groupBy("block").agg(F.collect_list(F.struct("item", "words")).alias("pieces")), "phrase-blocks")
    asked = keep(cut.select("block", F.explode("words").alias("word")).distinct(), "phrase-words")

    postings = index.where("word <> x''").select("shard", "word", "n", "gaps")
    if asked.limit(MAX_BROADCAST_WORDS + 1).count() <= MAX_BROADCAST_WORDS:
        lists = postings.join(F.broadcast(asked), "word")
    else:
        # A frequent word has a row in every shard: salted by shard, they don't meet in one task.
        salts = partitions(index.sparkSession)
        salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
        lists = postings.withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(salts))).join(salted, ["word", "salt"])
    heads = index.where("word = x''").select("shard", "starts", "lengths").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    heads = heads.join(F.broadcast(blocks) if n_blocks <= MAX_BROADCAST_BLOCKS else blocks, "block")
    cells = lists.select("shard", "block", "word", "n", "gaps").unionByName(heads, allowMissingColumns=True)
    return cells.groupBy("shard", "block").applyInArrow(_searching(window, slop), _FOUND)


def covered(spans: Column) -> Column:
    """How many words lie in some of the (start, end) spans, sorted by start."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("n"),
        F.greatest(a["reach"], s["end"]).alias("reach"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")), step, lambda a: a["n"].cast("long"))


# ---------------------------------------------------------------- query
def op11_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words inside exact occurrences of benchmark windows, and the items they come from."""
    index = build_index(table(spark, sf_dir, "documents"))
    found = search(index, table(spark, sf_dir, "benchmark"))
    hits = found.groupBy("shard", "row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
                                             F.sort_array(F.collect_set("item")).alias("items"))
    some = F.coalesce("items", F.array().cast("array<string>"))
    return documents(index).join(hits, ["shard", "row"], "left").select(
        "doc_id", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.size(some).cast("long").alias("n_items"), F.sha2(F.array_join(some, ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"))


# Item and document windows as strings; the words in occurrences counted one by one.
_ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(list_slice(ws, k, k + least(10, len(ws)) - 1), ' ') AS g
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, m, k, array_to_string(list_slice(ws, k, k + m - 1), ' ') AS g
       FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS k FROM d, sizes WHERE len(ws) >= m)),
hit AS (SELECT doc_id, item_id, k, m FROM dw JOIN iw USING (m, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM (SELECT DISTINCT doc_id, k, m FROM hit))
      GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

QUERIES = {"op11_positional_decontamination": op11_positional_decontamination}
ORACLE = {"op11_positional_decontamination": _ORACLE}
