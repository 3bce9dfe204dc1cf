"""The positional index against a scan of every text."""

import random
from collections import Counter

import numpy as np
import pytest

from vaultsmith.llm import phrases

DOCS = "doc_id long, text string, shard string, word string, item string"
ITEMS = "item_id string, text string, row string, pieces string"


def plain(text):
    return phrases.words(None if text is None else text.encode())


def test_words():
    assert plain("Ab-c1 ÀÉ\x85x\n_y's\x00z") == [b"ab", b"c1", "ÀÉ\x85x".encode(), b"y", b"s", b"z"]
    assert plain(None) == plain("") == plain(" .,\n") == []


def test_gap_code_round_trip():
    gaps = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1, 5])
    code, size = phrases.gap_bytes(gaps)
    assert size.tolist() == [1, 1, 1, 2, 2, 3, 4, 5, 5, 1]
    assert phrases.gaps_of(code).tolist() == gaps.tolist()
    assert phrases.gaps_of(phrases.gap_bytes(np.empty(0, np.int64))[0]).tolist() == []


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünï", "x" * 90, "x" * 91]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [("a", text(3)), ("b", text(4)), ("b", text(4)), (None, text(3)), ("c", "W1 w2"), ("d", None), ("e", ""),
             ("f", text(60)), ("g", text(4)), ("h", "unheard of words here"), ("i", "x" * 90 + " w3 " + "x" * 91)]
    docs = [(k, text(rng.choice([0, 1, 5, 40, 300]))) for k in range(60)]
    docs += [(1, None), (None, items[1][1]), (None, "--"), (7, f"{items[0][1]}; {items[1][1]}.\n{items[4][1]}"),
             (8, " ".join([items[7][1]] * 3)), (9, "w3 " + items[7][1] * 2000), (8, " ".join([items[7][1]] * 3))]
    return (docs, items, spark.createDataFrame([(i, t, "s", "w", "i") for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, "r", "p") for i, t in items], ITEMS))


def found_words(rows, kind):
    """(doc row, item) -> the word numbers found."""
    out = {}
    for r in rows:
        if r["kind"] == kind:
            out.setdefault((r["shard"], r["row"], r["item"]), set()).update(range(r["start"], r["end"]))
    return out


def windows_of(items, window):
    for i, t in items:
        ws = [phrases.term(w) for w in plain(t)]
        for k in range(max(len(ws) - window, 0) + 1 if ws else 0):
            yield i, ws[k:k + window]


def documents_of(index, docs):
    rows = phrases.documents(index).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in rows) == Counter((i, len(plain(t))) for i, t in docs)
    # Rows of a partition keep their order, so equal (id, number of words) are told apart by order.
    order = {}
    for i, t in docs:
        order.setdefault((i, len(plain(t))), []).append([phrases.term(w) for w in plain(t)])
    return {(r["shard"], r["row"]): order[r["doc_id"], r["n_words"]].pop(0)
            for r in sorted(rows, key=lambda r: (r["shard"], r["row"]))}


@pytest.mark.parametrize("shard_words,block_windows", [(phrases.SHARD_WORDS, phrases.BLOCK_WINDOWS), (200, 5)])
def test_exact_and_near_matches_equal_a_scan(spark, tables, shard_words, block_windows):
    docs, items, d, i = tables
    window, slop = 4, 2
    index = phrases.build_index(d, shard_words=shard_words)
    texts = documents_of(index, docs)
    rows = phrases.search(index, i, window=window, slop=slop, block_windows=block_windows).collect()
    exact, near = {}, {}
    for key, ws in texts.items():
        if len(ws) > 1000:
            continue
        for item, part in windows_of(items, window):
            m, need = len(part), Counter(part)
            hits = [s for s in range(len(ws) - m + 1) if ws[s:s + m] == part]
            for s in hits:
                exact.setdefault((*key, item), set()).update(range(s, s + m))
            holds = {(s, e) for s in range(len(ws)) for e in range(s + m, min(s + m + slop, len(ws)) + 1)
                     if not need - Counter(ws[s:e])}
            for s, e in holds:
                inner = any(o != (s, e) and s <= o[0] and o[1] <= e for o in holds)
                if not inner and not (e - s == m and s in hits):
                    near.setdefault((*key, item), set()).update(range(s, e))
    short = {k for k, ws in texts.items() if len(ws) <= 1000}
    assert {k: v for k, v in found_words(rows, "phrase").items() if k[:2] in short} == exact
    assert {k: v for k, v in found_words(rows, "near").items() if k[:2] in short} == near
    # The very long text repeats an item from its second word on.
    whole = [v for k, v in found_words(rows, "phrase").items() if k[:2] not in short and k[2] == "f"]
    assert len(whole) == 1 and min(whole[0]) == 1


def test_many_words_are_joined_salted(spark, tables, monkeypatch):
    _, _, d, i = tables
    index = phrases.build_index(d, shard_words=100)
    rows = lambda: sorted(map(repr, phrases.search(index, i, window=4).collect()))
    expected = rows()
    monkeypatch.setattr(phrases, "MAX_BROADCAST_WORDS", 1)
    monkeypatch.setattr(phrases, "MAX_BROADCAST_BLOCKS", 0)
    assert rows() == expected


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE_WINDOWS", 3)
    import pyarrow as pa

    ws = [f"w{k}" for k in range(17)]
    batch = pa.record_batch([pa.array(["a", "b"]), pa.array([" ".join(ws).encode(), b"two words"])], names=["id", "text"])
    out = next(phrases._cutting(4)(iter([batch]))).to_pylist()
    seen = [tuple(r["words"][k:k + 4]) for r in out if r["item"] == "a" for k in range(r["windows"])]
    assert seen == [tuple(w.encode() for w in ws[k:k + 4]) for k in range(14)]
    assert [r["words"] for r in out if r["item"] == "b"] == [[b"two", b"words"]]


def test_empty_tables(tables):
    _, _, d, i = tables
    index = phrases.build_index(d)
    assert phrases.search(index, i.where("false")).count() == 0
    none = phrases.build_index(d.where("false"))
    assert phrases.documents(none).count() == 0 and phrases.search(none, i).count() == 0
