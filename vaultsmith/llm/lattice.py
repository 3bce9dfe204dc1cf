"""Subword encoding by relational lattices, and decoding.

A text becomes ``▁`` + text with spaces as ``▁``, cut into units wherever two neighbouring
characters stand side by side in no piece of the model: no merge can reach across, so the
ids of a text are those of its units in order. Each distinct unit of the corpus is
encoded once:

1. explode its substrings of two characters and more, up to the longest piece,
2. equi-join them to the piece table (bounded by the vocabulary, so broadcast),
3. group the edges by unit, each packed into a long, and fold them: from single characters
   on, every step merges the adjacent pair whose piece has the best score (the leftmost of
   equals), until no pair makes a piece. These are sentencepiece's own ids for a model of
   merges; one that encodes otherwise is refused.

All of that runs in the partitions that counting the units made: no further shuffle. The
fold takes a step of all units of an Arrow batch at once. It holds the boundaries between
symbols in one long, so units of more than ``LONG_UNIT`` characters take the same merges
one by one. A character without a piece is written as its UTF-8 bytes' pieces.

Texts are then encoded by dictionary look-up. A dictionary of at most
``MAX_BROADCAST_UNITS`` units of at most ``MAX_BROADCAST_CHARS`` characters is packed
(hash, ids) and broadcast. Of a larger one the most frequent units are; the others, each
once for a text that has it, are joined with the dictionary and meet the texts in the one
shuffle that these take part in, compressed.

Defined results: null and empty texts have no ids; repeated rows are encoded each; a null
doc_id is a row like any other; ``▁`` in a text decodes as a space; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_removed
from ._common import keep, table
from ._tokens import tokenizer_path

SPACE = "▁"
MAX_BROADCAST_UNITS = 1 << 22
MAX_BROADCAST_CHARS = 64
MAX_HELD = 200_000
#: Beyond the broadcast, texts and their rare units meet by a hash of so many values.
PLACES = 1 << 24
#: Units are ranked by the logarithm of their count: so many steps double it.
COUNT_STEPS = 8
#: Boundaries of a folded unit are the bits of a long.
LONG_UNIT = 61
#: An edge is a long as well: rank of its score, start, size and id, from these bits on (id: 0).
RANK, START, SIZE = 36, 30, 24
_PROBE = ["Enpaeux", "relationship of words", "  two  spaces ", "ñandú 漢字 😀\t\n", "aaaaaaa"]
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)


def _pairs(codes: np.ndarray) -> np.ndarray:
    """One number for each two neighbouring characters."""
    return codes[:-1] << 21 | codes[1:]


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in ``known`` (sorted), and where."""
    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
    return (known[at] == values if len(known) else np.zeros(len(values), bool)), at


class Pieces:
    """The model's pieces, read once per process."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.text = [m.id_to_piece(i) for i in range(n)]
        self.usable = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.score = [m.get_score(i) for i in range(n)]
        self.first_byte = m.piece_to_id("<0x00>")
        self.longest = max(len(self.text[i]) for i in self.usable)
        neighbours = {t[k:k + 2] for t in map(self.text.__getitem__, self.usable) for k in range(len(t) - 1)}
        crossing = [p for p in neighbours if p[1] == SPACE and p[0] != SPACE]
        if crossing or not m.is_byte(self.first_byte):
            raise ValueError(f"{path}: needs byte pieces and no piece across the start of a word, found {crossing[:3]}")
        self.joined = np.sort(_pairs(_codes("".join(neighbours)))[::2])
        single = sorted((ord(self.text[i]), i) for i in self.usable if len(self.text[i]) == 1)
        self.characters, self.character_ids = np.array(single, np.int64).reshape(-1, 2).T
        self.by_text = {self.text[i]: (self.score[i], i) for i in self.usable}
        self.bytes = [self.text[i].replace(SPACE, " ").encode() for i in range(n)]
        for b in range(256):
            self.bytes[self.first_byte + b] = bytes([b])
        for probe in _PROBE:
            if [i for u in units(probe, self) for i in best_path(u, self)] != m.encode(probe):
                raise ValueError(f"{path}: not a model of merges alone, tried {probe!r}")


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


Batches = Iterator[pa.RecordBatch]
ENCODED = "doc_id long, text string, ids binary"


def _few(batches: Batches, rows: int = 512) -> Batches:
    """The batches in small slices, which bounds what a worker holds besides its input."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def words(text: str | None) -> list[str]:
    """Runs of ``▁`` with the other characters behind them, each without its first ``▁``."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " ":
        return [w[1:] for w in _UNITS(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


def cut(found: list[str], model: Pieces) -> tuple[list[str], np.ndarray]:
    """The units of some ``words`` in order, and how many each word has."""
    if not found:
        return [], np.zeros(0, np.int64)
    text = SPACE + SPACE.join(found)
    begins = np.zeros(len(text), bool)
    begins[1:] = ~_among(_pairs(_codes(text)), model.joined)[0]
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    first = np.cumsum(sizes) - sizes
    begins[first] = True
    at = np.flatnonzero(begins)
    edges = [*at.tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])], np.diff(np.append(np.searchsorted(at, first), len(at)))


def units(text: str | None, model: Pieces) -> list[str]:
    return cut(words(text), model)[0]


def _counting(model_path: str):
    def run(batches: Batches) -> Batches:
        model = pieces(model_path)
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            found: dict[str, int] = {}
            parts, sizes = cut(list(held), model)
            for u, n in zip(parts, np.repeat(np.fromiter(held.values(), np.int64, len(held)), sizes).tolist()):
                found[u] = found.get(u, 0) + n
            held.clear()
            return pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["unit", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(words(text.as_py()))
                if len(held) > MAX_HELD:
                    yield flush()
        yield flush()

    return run


def _merged(sizes: np.ndarray, owner: np.ndarray, around: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Bitmaps of the boundaries left in units of some ``sizes``.

    Edges are matched substrings in the order (unit, rank, start). One can be merged while
    both its ends (``around``) are boundaries and one more is ``within`` it; merging removes
    that one.
    """
    m = (np.uint64(2) << sizes.astype(np.uint64)) - np.uint64(1)
    one = np.uint64(1)
    while len(owner):
        here = m[owner]
        inner = here & within
        # Boundaries only vanish: substrings without their ends, or merged already, are done with.
        alive = ((here & around) == around) & (inner != 0)
        owner, around, within, inner = owner[alive], around[alive], within[alive], inner[alive]
        at = np.flatnonzero((inner & (inner - one)) == 0)
        best = at[np.diff(owner[at], prepend=-1) != 0]
        m[owner[best]] &= ~inner[best]
        going = np.zeros(len(m), bool)
        going[owner[best]] = True
        on = going[owner]
        owner, around, within = owner[on], around[on], within[on]
    return m


def _folded(found: list[str], lists: pa.ListArray, model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units from their packed edges, and how many each unit has."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    owner = np.repeat(np.arange(len(found)), np.diff(np.asarray(lists.offsets)))
    edges = np.asarray(lists.flatten(), np.int64)
    owner, edges = owner[edges >= 0], edges[edges >= 0]  # the empty piece is none
    order = np.lexsort((edges, owner))
    owner, edges = owner[order], edges[order]
    start = edges >> START & 63
    low, high = (np.uint64(1) << x.astype(np.uint64) for x in (start, start + (edges >> SIZE & 63)))
    around, within = low | high, high - (low << np.uint64(1))
    m = _merged(sizes, owner, around, within)

    first = np.cumsum(sizes) - sizes
    text = "".join(found)
    unit = np.repeat(np.arange(len(found)), sizes)
    boundary = (m[unit] >> (np.arange(len(text)) - first[unit]).astype(np.uint64) & np.uint64(1)).astype(bool)
    known, at = _among(_codes(text), model.characters)
    ids = np.where(known, model.character_ids[at], -1) if len(model.characters) else np.full(len(text), -1)
    whole = ((m[owner] & around) == around) & ((m[owner] & within) == 0)
    ids[first[owner[whole]] + start[whole]] = edges[whole] & ((1 << SIZE) - 1)

    symbols = np.flatnonzero(boundary)
    ids, unit = ids[symbols], unit[symbols]
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        raw = [text[k].encode() for k in symbols[unknown].tolist()]
        times = np.ones(len(ids), np.int64)
        times[unknown] = [len(r) for r in raw]
        ids, unit = np.repeat(ids, times), np.repeat(unit, times)
        ids[ids < 0] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + model.first_byte
    return ids, np.bincount(unit, minlength=len(found))


def _folding(model_path: str):
    def run(batches: Batches) -> Batches:
        model = pieces(model_path)
        for batch in batches:
            found = batch.column(0).to_pylist()
            long = [k for k, u in enumerate(found) if len(u) > LONG_UNIT]
            # These have the empty piece only, and are put in afterwards.
            ids, counts = _folded([u if len(u) <= LONG_UNIT else "" for u in found], batch.column(2), model)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
            if long:
                held = lists.to_pylist()
                for k in long:
                    held[k] = best_path(found[k], model)
                lists = pa.array(held, pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), batch.column(1), lists], names=["unit", "n", "ids"])

    return run


def best_path(unit: str, model: Pieces) -> list[int]:
    """Ids of one unit: the adjacent pair with the best score is merged until none is left."""
    stop = list(range(1, len(unit) + 1))  # end of the symbol that starts here, 0 if none does
    before = list(range(-1, len(unit)))  # start of the symbol in front
    waiting: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        """The symbols that start at a and b, if they are there and make a piece."""
        if a >= 0 and b < len(unit) and stop[b] - a <= model.longest:
            found = model.by_text.get(unit[a:stop[b]])
            if found:
                heapq.heappush(waiting, (-found[0], a, b, stop[b]))

    for k in range(1, len(unit)):
        offer(k - 1, k)
    while waiting:
        _, a, b, end = heapq.heappop(waiting)
        if stop[a] == b and stop[b] == end:
            stop[a], stop[b], before[end] = end, 0, a
            offer(before[a], a)
            offer(a, end)
    out: list[int] = []
    at = 0
    while at < len(unit):
        found = model.by_text.get(unit[at:stop[at]])
        out += [found[1]] if found else [model.first_byte + b for b in unit[at].encode()]
        at = stop[at]
    return out


def dictionary(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """unit, n (occurrences), ids of every distinct unit of the texts."""
    spark, model = docs.sparkSession, pieces(model_path)
    counted = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_counting(model_path), "unit string, n long")
               .groupBy("unit").agg(F.sum("n").alias("n")))
    # The empty piece keeps units without any matching substring.
    rank = {score: k for k, score in enumerate(sorted({model.score[i] for i in model.usable}, reverse=True))}
    rows = [(model.text[i], (rank[model.score[i]] << RANK) + i) for i in model.usable if len(model.text[i]) > 1] + [("", -1)]
    known = F.broadcast(spark.createDataFrame(rows, "piece string, code long"))
    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.length("unit") - 2), lambda a: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(model.longest), F.length("unit") - a)),
        lambda n: F.struct((F.shiftleft(a.cast("long"), START) + F.shiftleft(n.cast("long"), SIZE)).alias("place"),
                           F.substring("unit", a + 1, n).alias("piece")))))
    empty = F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit("").alias("piece")))
    short = F.length("unit").between(2, LONG_UNIT)
    edges = counted.select("unit", "n", F.explode(F.when(short, F.concat(spans, empty)).otherwise(empty)).alias("s")).select(
        "unit", "n", "s.place", "s.piece").join(known, "piece")
    listed = edges.groupBy("unit", "n").agg(F.collect_list(F.col("code") + F.col("place")).alias("edges"))
    with shuffles_removed(spark):
        return keep(listed.mapInArrow(_folding(model_path), "unit string, n long, ids array<int>"), "lattice-dictionary")


# ------------------------------------------------------------- applying a dictionary
def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = np.array([xxhash.xxh3_64_intdigest(u) for u in batch.column(0).to_pylist()], np.uint64)
        lists = batch.column(1)
        flat = np.asarray(lists.flatten()).astype("<u4")
        sizes = np.diff(np.asarray(lists.offsets)).astype("<u4")
        yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (hashes, sizes, flat)], names=["h", "s", "i"])


class PackedDictionary:
    """Unit hash -> ids in three arrays, in the order of the hashes."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        first = np.append(0, np.cumsum(sizes[order]))
        self.first = first.astype(np.uint32) if first[-1] < 1 << 32 else first
        self.ids = ids[_runs((np.cumsum(sizes) - sizes)[order], sizes[order])]
        if len(ids) and ids.max() < 1 << 16:
            self.ids = self.ids.astype(np.uint16)
        self.unique = bool((self.hashes[1:] != self.hashes[:-1]).all())

    def has(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each unit is here, and where."""
        return _among(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)), self.hashes)

    def find(self, found: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of units in order, and how many each has: none if it is not here."""
        here, at = self.has(found)
        if not len(self.hashes):
            return b"", np.zeros(len(found), np.int64)
        first = self.first[at].astype(np.int64)
        sizes = np.where(here, self.first[at + 1].astype(np.int64) - first, 0)
        return self.ids[_runs(first, sizes)].astype("<u4").tobytes(), sizes


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs that start at ``first``, one run behind the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _pack(known: DataFrame, without: set[int] = frozenset()) -> PackedDictionary:
    """The units of ``known`` but those whose hash is in ``without``."""
    rows = known.select("unit", "ids").mapInArrow(_packing, "h binary, s binary, i binary").collect()
    join = lambda c, t: np.frombuffer(b"".join(bytes(r[c]) for r in rows), t)
    hashes, sizes, ids = join("h", np.uint64), join("s", "<u4").astype(np.int64), join("i", "<u4")
    if without:
        stay = ~np.isin(hashes, np.array(sorted(without), np.uint64))
        hashes, sizes, ids = hashes[stay], sizes[stay], ids[np.repeat(stay, sizes)]
    return PackedDictionary(hashes, sizes, ids)


def _learn(held: dict[str, bytes], new: list[str], packed: PackedDictionary, model: Pieces,
           rare: dict[str, bytes] | None = None) -> list[str]:
    """Adds the ids of words, as bytes. Returns the words with units that only ``rare`` has."""
    parts, counts = cut(new, model)
    ids, sizes = packed.find(parts)
    here = sizes > 0
    first = np.append(0, np.cumsum(counts))
    at = 4 * np.append(0, np.cumsum(sizes))
    ends = at[first].tolist()
    held.update(zip(new, [ids[a:b] for a, b in zip(ends, ends[1:])]))
    mixed = np.unique(np.repeat(np.arange(len(new)), counts)[~here]).tolist()
    for w in mixed:
        held[new[w]] = b"".join([ids[at[k]:at[k + 1]] if here[k] else rare[parts[k]] for k in range(first[w], first[w + 1])])
    return [new[w] for w in mixed]


def _looking_up(shared, model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, model = shared.value, pieces(model_path)
        held: dict[str, bytes] = {}
        for batch in _few(batches):
            if len(held) > MAX_HELD:
                held.clear()
            split = [words(t.as_py()) for t in batch.column(1)]
            new = list({w for found in split for w in found if w not in held})
            _learn(held, new, packed, model)
            ids = [b"".join(map(held.__getitem__, found)) for found in split]
            for w in new:
                if len(w) > MAX_BROADCAST_CHARS:
                    del held[w]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])

    return run


def _place(doc_id: int | None, text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(text or "", seed=(doc_id or 0) & (1 << 64) - 1) % PLACES


def _rare_units(shared, model_path: str):
    """(place, unit) of the units of a text that the broadcast doesn't have, each once."""
    def run(batches: Batches) -> Batches:
        packed, model = shared.value, pieces(model_path)
        held: dict[str, list[str]] = {}
        for batch in _few(batches):
            if len(held) > MAX_HELD:
                held.clear()
            texts = batch.column(1).to_pylist()
            split = [words(t) for t in texts]
            new = list({w for found in split for w in found if w not in held})
            parts, counts = cut(new, model)
            missing = np.flatnonzero(~packed.has(parts)[0])
            owner = np.repeat(np.arange(len(new)), counts)[missing]
            held.update((w, ()) for w in new)
            for k, w in zip(missing.tolist(), owner.tolist()):
                held[new[w]] = [*held[new[w]], parts[k]]
            places, out = [], []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), texts, split):
                needed = {u for w in found for u in held[w]}
                places += [_place(doc_id, text)] * len(needed)
                out += needed
            for w in new:
                if len(w) > MAX_BROADCAST_CHARS:
                    del held[w]
            yield pa.record_batch([pa.array(places, pa.int32()), pa.array(out, pa.string())], names=["place", "unit"])

    return run


def _sending(batches: Batches) -> Batches:
    """Texts at their places, compressed: they are most of what is shuffled."""
    codec = pa.Codec("zstd")

    def packed(text: str | None) -> bytes | None:
        raw = None if text is None else text.encode()
        return raw if raw is None else len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True)

    for batch in _few(batches):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield pa.record_batch([pa.array(map(_place, ids, texts), pa.int32()), pa.nulls(len(ids), pa.string()),
                               pa.nulls(len(ids), pa.list_(pa.int32())), batch.column(0), pa.array(map(packed, texts), pa.binary())],
                              names=["place", "unit", "ids", "doc_id", "body"])


def _meeting(shared, model_path: str):
    """Encodes texts from the broadcast and the rare units that stand before them at their place."""
    def run(batches: Batches) -> Batches:
        packed, model, codec = shared.value, pieces(model_path), pa.Codec("zstd")
        held: dict[str, bytes] = {}
        rare: dict[str, bytes] = {}
        waiting: list[tuple[int | None, str | None]] = []

        def flush() -> pa.RecordBatch:
            if len(held) > MAX_HELD:
                held.clear()
            split = [words(t) for _, t in waiting]
            new = list({w for found in split for w in found if w not in held})
            passing = _learn(held, new, packed, model, rare)
            ids = [b"".join(map(held.__getitem__, found)) for found in split]
            for w in {*passing, *(w for w in new if len(w) > MAX_BROADCAST_CHARS)}:
                del held[w]
            out = pa.record_batch([pa.array([d for d, _ in waiting], pa.int64()), pa.array([t for _, t in waiting], pa.string()),
                                   pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])
            waiting.clear()
            return out

        here = None
        for batch in batches:
            for place, unit, ids, doc_id, body in zip(*[c.to_pylist() for c in batch.columns]):
                if place != here and len(waiting) >= 256:
                    yield flush()
                    rare.clear()
                elif len(waiting) >= 2048:
                    yield flush()
                here = place
                if unit is not None:
                    rare[unit] = np.array(ids, "<u4").tobytes()
                else:
                    waiting.append((doc_id, None if body is None else codec.decompress(
                        body[4:], int.from_bytes(body[:4], "little"), asbytes=True).decode()))
        if waiting:
            yield flush()

    return run


def _clashes(known: DataFrame) -> set[int]:
    """Hashes that several units share: a few at most, of 64 bits."""
    def hashed(batches: Batches) -> Batches:
        for batch in batches:
            h = np.array([xxhash.xxh3_64_intdigest(u) for u in batch.column(0).to_pylist()], np.uint64)
            yield pa.record_batch([pa.array(h.view(np.int64))], names=["h"])

    shared = known.select("unit").mapInArrow(hashed, "h long").groupBy("h").count().where("count > 1").collect()
    return {r["h"] & (1 << 64) - 1 for r in shared}


def _joined(pairs: DataFrame, known: DataFrame, model_path: str, max_units: int, then: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """Look-up for dictionaries of any size: frequent units by broadcast, rare ones by joins."""
    spark = pairs.sparkSession
    step = F.floor(F.log2(F.col("n").cast("double")) * COUNT_STEPS)
    short = F.length("unit") <= MAX_BROADCAST_CHARS
    least, total = None, 0
    with shuffles_removed(spark):
        for row in sorted(known.where(short).groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
            total += row["count"]
            if total > max_units:
                break
            least = row["step"]
        clashes = _clashes(known)
    frequent = F.lit(False) if least is None else short & (step >= least)
    shared = spark.sparkContext.broadcast(_pack(known.where(frequent), clashes))
    others = known.select("unit", "ids") if clashes else known.where(~frequent).select("unit", "ids")
    needed = pairs.mapInArrow(_rare_units(shared, model_path), "place int, unit string").join(others, "unit")
    texts = pairs.mapInArrow(_sending, "place int, unit string, ids array<int>, doc_id long, body binary")
    met = texts.unionByName(needed, allowMissingColumns=True).repartition("place").sortWithinPartitions("place", F.col("unit").isNull())
    encoded = _meeting(shared, model_path)
    return met.mapInArrow(lambda b: then(encoded(b)), schema)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           max_units: int = MAX_BROADCAST_UNITS, then: Callable[[Batches], Batches] = iter,
           schema: str = ENCODED) -> DataFrame:
    """doc_id, text, ids (little-endian unsigned 32-bit numbers) of every row.

    ``then`` may turn these batches into others (of ``schema``) in the same worker, which
    saves a second Python process per task.
    """
    spark = docs.sparkSession
    pairs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = dictionary(pairs, model_path)
    size = known.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("unit")).alias("longest")).first()
    if size["n"] <= max_units and (size["longest"] or 0) <= MAX_BROADCAST_CHARS:
        packed = _pack(known)
        if packed.unique:
            look_up = _looking_up(spark.sparkContext.broadcast(packed), model_path)
            return pairs.mapInArrow(lambda b: then(look_up(b)), schema)
    return _joined(pairs, known, model_path, max_units, then, schema)


def decode_ids(ids: np.ndarray, model: Pieces) -> str:
    """Text of ids: pieces and bytes joined, without the space put in front."""
    return b"".join([model.bytes[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


def _decoding(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            texts = [decode_ids(np.frombuffer(x.as_buffer(), "<u4"), model) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoding(model_path), "doc_id long, text string")


# ---------------------------------------------------------------- query
def _checking(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            n, crc, same = [], [], []
            for text, ids in zip(batch.column(1), batch.column(2)):
                data = ids.as_py()
                n.append(len(data) // 4)
                crc.append(zlib.crc32(data))
                same.append(decode_ids(np.frombuffer(data, "<u4"), model) == (text.as_py() or "").replace(SPACE, " "))
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)],
                                  names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    return run


def op7_lattice_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, with a checksum of its ids and whether they decode to it."""
    path = tokenizer_path("piece_bpe_32k.model")
    return encode(table(spark, sf_dir, "documents"), path, then=_checking(path),
                  schema="doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


QUERIES = {"op7_lattice_encoding": op7_lattice_encoding}
ORACLE: dict[str, str] = {}
