"""Dictionaries beyond the broadcast: frequent units by broadcast, rare ones by a join."""

import numpy as np
import pytest
import sentencepiece as spm
import xxhash
from pyspark.sql import functions as F

from vaultsmith.llm import lattice
from vaultsmith.llm._tokens import tokenizer_path
from vaultsmith.plans.explain import plan_text

PIECE = tokenizer_path("piece_bpe_32k.model")


@pytest.mark.parametrize("max_units", [1, 4, 40])
def test_frequent_and_rare_units_give_the_same_ids(spark, max_units):
    model = spm.SentencePieceProcessor(model_file=PIECE)
    texts = [f"the same words and one rare {w}{k}, the" for k, w in enumerate(["zqx", "漢字", "ñandú", "w" * 70] * 6)]
    rows = [*enumerate(texts), (None, "the"), (None, None), (3, ""), (3, texts[3]), (3, texts[3]), (None, "zqx0 zqx4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    encoded = lattice.encode(df, PIECE, max_units=max_units)
    got = sorted((str(r["doc_id"]), str(r["text"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in encoded.collect())
    assert got == sorted((str(i), str(t), model.encode(t or "")) for i, t in rows)


def test_occurrences_of_frequent_units_are_not_shuffled(spark):
    """A text goes through one exchange, with what only the dictionary has."""
    df = spark.createDataFrame([(k, "the same words " * 50 + f"zqx{k}") for k in range(20)], "doc_id long, text string")
    known = lattice.dictionary(df.select("doc_id", "text"), PIECE)
    frequent = known.where("n >= 100")
    packed = lattice._pack(frequent)
    found = [u for _, t in df.collect() for u in lattice.units(t, lattice.pieces(PIECE))]
    here = packed.has(found)[0]
    assert here.sum() > 1000 > (~here).sum() > 0
    shared = spark.sparkContext.broadcast(packed)
    needed = df.mapInArrow(lattice._rare_units(shared, PIECE), "place int, unit string").collect()
    assert len(needed) == len({(r["place"], r["unit"]) for r in needed}) <= (~here).sum()
    assert "Sort" in plan_text(lattice.encode(df, PIECE, max_units=5), "simple")
    text = plan_text(lattice.encode(df, PIECE, max_units=5), "simple")
    assert "posexplode" not in text and text.count("Scan ExistingRDD") == 2


def test_units_whose_hash_is_shared_are_not_broadcast(spark):
    known = spark.createDataFrame([("the", [1]), ("of", [2, 3]), ("and", [4])], "unit string, ids array<int>")
    packed = lattice._pack(known, {xxhash.xxh3_64_intdigest("of")})
    assert packed.has(["the", "of", "and"])[0].tolist() == [True, False, True]
    assert np.frombuffer(packed.find(["the", "of", "and"])[0], "<u4").tolist() == [1, 4]
    assert lattice._clashes(known.select("unit", F.lit(1).alias("n"))) == set()
