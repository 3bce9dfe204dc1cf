"""Vector codes against distances of every part to every entry."""

import numpy as np
import pytest

from vaultsmith.llm import parttrie as t

SCHEMA = "vec_id long, embedding array<double>, label int, item string, row string, position string"


def brute(vectors, parts, entries, rounds):
    """Codes, errors and codebooks; ``vectors`` in order of (id, vector)."""
    v = np.array(vectors, np.int64).reshape(len(vectors), parts, -1)
    books = v[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((v[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(rounds):
        best, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = v[best[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    best, least = assign()
    return best, least.sum(axis=1), books


@pytest.mark.parametrize("subtree", [1, 3, 4096])
def test_walk_finds_the_nearest_entry(subtree):
    rng = np.random.default_rng(12)
    for width in (1, 2, 4):
        parts = rng.integers(-3, 4, (300, width))
        parts = parts[np.lexsort(parts.T[::-1])]
        entries = rng.integers(-3, 4, (7, width))
        d = ((parts[:, None] - entries) ** 2).sum(axis=2)
        best, least = t.walk(parts, entries, subtree)
        assert best.tolist() == d.argmin(axis=1).tolist() and least.tolist() == d.min(axis=1).tolist()


@pytest.mark.parametrize("n,entries", [(400, 16), (5, 16), (1, 4)])
def test_codes_equal_brute_force(spark, n, entries):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 8)).round(1)
    x[: n // 3] = 0  # a third of all vectors are alike: a hot part
    ids = [None if k == 3 else k // 2 for k in range(n)]
    rows = [(i, v.tolist(), None, "i", "r", "p") for i, v in zip(ids, x)]
    rng.shuffle(rows)
    odd = [(1, None, 1, "i", "r", "p"), (2, [], 1, "i", "r", "p"), (3, [float("nan")] + [0.0] * 7, 1, "i", "r", "p"),
           (4, [None] + [0.0] * 7, 1, "i", "r", "p"), (5, [float("inf")] * 8, 1, "i", "r", "p"), (6, [1.0] * 4, 1, "i", "r", "p")]
    df = spark.createDataFrame([*rows, *odd], SCHEMA)
    coded, books = t.compress(df, item=df["label"], parts=4, entries=entries, scale=10)
    order = sorted(([r[0] is None, r[0] or 0, np.floor(np.array(r[1]) * 10).astype(int).tolist()] for r in rows))
    best, error, expected = brute([r[2] for r in order], 4, entries, t.ROUNDS)
    assert books == expected.tolist()
    got = sorted((r["id"] is None, r["id"] or 0, r["codes"], r["error"]) for r in coded.collect())
    assert got == sorted((r[0], r[1], c, e) for r, c, e in zip(order, best.tolist(), error.tolist()))


def test_empty_and_bad_lengths(spark):
    none = spark.createDataFrame([], SCHEMA)
    coded, books = t.compress(none)
    assert coded.count() == 0 and books == [] and len(t.codebooks_sha256(books)) == 64
    with pytest.raises(ValueError, match="equal parts"):
        t.compress(spark.createDataFrame([(1, [1.0] * 5, None, "i", "r", "p")], SCHEMA), parts=4)
