"""The lattice's fold, cut and packed dictionary against one unit at a time."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from vaultsmith.llm import lattice
from vaultsmith.llm._tokens import tokenizer_path

PIECE = tokenizer_path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "e", "th", "er", "tion", "aaaa", ".", "\n", "\x07", "é", "漢", "😀", "▁", "▁▁"]


def _units(n: int) -> list[str]:
    rng = random.Random(7)
    found = {"".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 24))) for _ in range(n)}
    return sorted(found | {"a" * 61, "a" * 62, "th" * 40, "a", "▁", "😀"})


def test_units_folded_together_are_the_units_folded_alone():
    model = lattice.pieces(PIECE)
    found = _units(3000)
    rank = {s: k for k, s in enumerate(sorted({model.score[i] for i in model.usable}, reverse=True))}

    def edges(u: str) -> list[int]:
        out = [-1]
        for a in range(len(u) if len(u) <= lattice.LONG_UNIT else 0):
            for n in range(2, min(model.longest, len(u) - a) + 1):
                if u[a:a + n] in model.by_text:
                    score, i = model.by_text[u[a:a + n]]
                    out.append((rank[score] << lattice.RANK) + (a << lattice.START) + (n << lattice.SIZE) + i)
        return out

    batch = pa.record_batch([pa.array(found), pa.array([1] * len(found)), pa.array([edges(u) for u in found], pa.list_(pa.int64()))],
                            names=["unit", "n", "edges"])
    folded = list(lattice._folding(PIECE)(iter([batch, batch.slice(0, 0), batch.slice(5, 9)])))
    want = [lattice.best_path(u, model) for u in found]
    assert folded[0].column(2).to_pylist() == want
    assert folded[1].num_rows == 0
    assert folded[2].column(2).to_pylist() == want[5:14]


def test_cut_of_many_words_is_the_cut_of_each():
    model = lattice.pieces(PIECE)
    joined = {t[k:k + 2] for t in model.by_text for k in range(len(t) - 1)}
    found = ["", "▁", "", *_units(500), ""]
    units, counts = lattice.cut(found, model)
    assert sum(counts) == len(units)
    at = 0
    for word, n in zip(found, counts.tolist()):
        mine = units[at:at + n]
        assert "".join(mine) == "▁" + word
        assert [a[-1] + b[0] in joined for a, b in zip(mine, mine[1:])] == [False] * (n - 1)
        assert all(u[k:k + 2] in joined for u in mine for k in range(len(u) - 1))
        at += n


def test_packed_dictionary_is_small_and_finds_every_unit():
    ids = [[7 + k % 3000] * (1 + k % 4) for k in range(5000)]
    found = [f"u{k}" for k in range(5000)]
    packed_rows = next(lattice._packing(iter([pa.record_batch([pa.array(found), pa.array(ids, pa.list_(pa.int32()))], names=["unit", "ids"])])))
    h, s, i = (np.frombuffer(c[0].as_py(), t) for c, t in zip(packed_rows.columns, (np.uint64, "<u4", "<u4")))
    packed = lattice.PackedDictionary(h, s.astype(np.int64), i)
    assert packed.unique
    held = sum(a.nbytes for a in vars(packed).values() if isinstance(a, np.ndarray))
    assert held <= 12 * len(found) + 2 * sum(map(len, ids)) + 4
    asked = found[::-7]
    data, sizes = packed.find(asked)
    assert np.frombuffer(data, "<u4").tolist() == [x for u in asked for x in ids[int(u[1:])]]
    assert sizes.tolist() == [len(ids[int(u[1:])]) for u in asked]
